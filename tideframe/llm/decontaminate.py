"""Benchmark decontamination with a generalised suffix automaton.

Test items are normalised to words and put into one automaton, which knows
every run of words that any item contains.  Training words stream through it;
at each word the length of the longest run ending there is known.  Runs of
``window`` words or more, and whole items that are shorter, are contamination.

Items are cut into overlapping pieces and dealt to shards of bounded size.
One automaton is built per shard and broadcast in a compact form, about 50
bytes a word pickled; one pass over the documents asks all of them.  So a
worker holds the whole benchmark, and the plan is the same for any number of
shards.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.llm.common import LOWER, WORD, columns_of, free_names, hash_spans, mix, texts, word_spans, written

#: Consecutive item words that count as a leak.
WINDOW = 10
#: Words of a piece of an item, and of the items that share an automaton.
PIECE_WORDS = 2_000
SHARD_WORDS = 100_000
#: A document of which more than this share is benchmark text goes altogether.
MAX_COVERAGE = 0.5


class SuffixAutomaton:
    """All runs of words of several items, in states that share their ends."""

    def __init__(self, pieces: Iterable[tuple[str, list[bytes], bool]], window: int):
        """pieces: item, words, and whether these are the whole item."""
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        pieces = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws], whole)
                  for i, ws, whole in pieces]
        for _, ids, _ in pieces:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        in_window: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str]]] = {}
        self.shortest = window
        for item, ids, whole in pieces:
            v = 0
            for i, c in enumerate(ids):
                v = self.next[v][c]
                if i + 1 >= window:
                    in_window.setdefault(self._of_length(v, window), set()).add(item)
            if whole and 0 < len(ids) < window:
                short.setdefault(self._of_length(v, len(ids)), []).append((len(ids), item))
                self.shortest = min(self.shortest, len(ids))
        # Short items that end wherever a state ends: its own and those of its links.
        self.short: dict[int, list[tuple[int, str]]] = {}
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if found := short.get(v, []) + self.short.get(self.link[v], []):
                self.short[v] = found
        pairs = {(a, b) for _, ids, _ in pieces for a, b in zip(ids, ids[1:])}
        words = sorted(self.vocabulary, key=self.vocabulary.get)
        start = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
        size = np.array([len(w) for w in words], dtype=np.int64)
        joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
        h = hash_spans(start.astype(np.int64), start + size, joined)
        self.words = np.sort(h)
        self.pairs = np.unique(_pair(h[[a for a, _ in pairs]], h[[b for _, b in pairs]]))
        self._compact(in_window)

    def _compact(self, in_window: dict[int, set[str]]) -> None:
        """Steps as sorted keys (state, word) with their targets; equal sets of items once."""
        steps = sorted((v << 32 | c, to) for v, follow in enumerate(self.next) for c, to in follow.items())
        self.step_keys = array("q", (k for k, _ in steps))
        self.step_to = array("i", (to for _, to in steps))
        self.link, self.length = array("i", self.link), array("i", self.length)
        sets: dict[tuple[str, ...], int] = {}
        found = sorted((v, sets.setdefault(tuple(sorted(items)), len(sets))) for v, items in in_window.items())
        self.window_states = array("i", (v for v, _ in found))
        self.window_sets = array("i", (k for _, k in found))
        self.item_sets = list(sets)
        del self.next

    def _step(self, v: int, c: int) -> int:
        """The state after word ``c``; -1 if no item goes on like this."""
        key = v << 32 | c
        k = bisect_left(self.step_keys, key)
        return self.step_to[k] if k < len(self.step_keys) and self.step_keys[k] == key else -1

    def window_items(self, v: int) -> tuple[str, ...]:
        """Items with the window that ends in state ``v``, reached by at least a window of words."""
        state = self._of_length(v, self.window)
        return self.item_sets[self.window_sets[bisect_left(self.window_states, state)]]

    def _of_length(self, v: int, n: int) -> int:
        """The state of the last n words of a run that ends in v."""
        while self.length[self.link[v]] >= n:
            v = self.link[v]
        return v

    def _new(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(follow)
        return len(self.next) - 1

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        new = None if known is not None else self._new(self.length[last] + 1, 0, {})
        p = last
        if new is not None:
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p < 0:
                return new
        q = self.next[p][c]
        if self.length[q] != self.length[p] + 1:
            copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
            while p >= 0 and self.next[p].get(c) == q:
                self.next[p][c] = copy
                p = self.link[p]
            self.link[q] = copy
            q = copy
        if new is None:
            return q
        self.link[new] = q
        return new

    def stream(self, words: Iterable[bytes]) -> Iterator[tuple[int, int]]:
        """For each word the state and the length of the longest known run that ends there."""
        v = n = 0
        for w in words:
            c = self.vocabulary.get(w)
            if c is None:
                v = n = 0
            else:
                while (to := self._step(v, c)) < 0 and v:
                    v = self.link[v]
                    n = self.length[v]
                v, n = (to, n + 1) if to >= 0 else (0, 0)
            yield v, n


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(3) + b)


def _known(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


@dataclass
class Match:
    n_words: int = 0
    longest: int = 0
    items: set[str] = field(default_factory=set)
    #: Hit words [from, to), ascending, apart.
    spans: list[tuple[int, int]] = field(default_factory=list)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def match(automata: Sequence[SuffixAutomaton], raw: bytes) -> Match:
    """All hits of one text in any of the shards; its words are found and hashed once."""
    start, end, b = word_spans(raw)
    found = Match(len(start))
    if not automata or len(start) < min(a.shortest for a in automata):
        return found
    h, folded = hash_spans(start, end, b), b.tobytes()
    pair = _pair(h[:-1], h[1:])
    spans = [s for a in automata for s in _hits(a, h, pair, folded, start, end, found)]
    found.spans = _merged(spans)
    return found


def _hits(
    automaton: SuffixAutomaton, h: np.ndarray, pair: np.ndarray, folded: bytes,
    start: np.ndarray, end: np.ndarray, found: Match,
) -> list[tuple[int, int]]:
    """Hit words by one shard; adds its items and longest run to ``found``.

    Only stretches whose neighbouring words are all neighbours in some item
    can hold a hit; the automaton streams over these.
    """
    inside = _known(automaton.pairs, pair) if automaton.shortest > 1 else _known(automaton.words, h)
    extra = int(automaton.shortest > 1)
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    spans = []
    for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if j - i + extra < automaton.shortest:
            continue
        words = (folded[start[k]:end[k]] for k in range(i, j + extra))
        for k, (v, n) in enumerate(automaton.stream(words), i):
            found.longest = max(found.longest, n)
            if n >= automaton.window:
                spans.append((k + 1 - automaton.window, k + 1))
                found.items.update(automaton.window_items(v))
            for size, item in automaton.short.get(v, ()):
                if size <= n:
                    spans.append((k + 1 - size, k + 1))
                    found.items.add(item)
    return spans


def item_pieces(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, int]:
    """Pieces of the items (item, words, whole, shard) and the number of shards."""
    upper, lower = "".join(map(chr, LOWER)), "".join(map(chr, LOWER.values()))
    words = F.regexp_extract_all(
        F.translate(F.coalesce("text", F.lit("")), upper, lower), F.lit(WORD.pattern), F.lit(0)
    )
    rows = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("all")
    ).filter(F.size("all") > 0)
    begins = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)),
                        F.lit(PIECE_WORDS - window + 1))
    pieces = rows.select("item", "all", F.explode(begins).alias("at")).select(
        "item", "at", F.slice("all", F.col("at"), PIECE_WORDS).alias("words"),
        (F.size("all") < window).alias("whole"),
    )
    pieces = written(pieces, "benchmark-pieces")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    return pieces.withColumn("shard", F.pmod(F.xxhash64("item", "at"), F.lit(shards))), shards


def automata(items: DataFrame, window: int = WINDOW) -> Iterator[SuffixAutomaton]:
    """One automaton per shard.  A shard has SHARD_WORDS words on average."""
    pieces, shards = item_pieces(items, window)
    for s in range(shards):
        rows = pieces.filter(F.col("shard") == s).collect()
        yield SuffixAutomaton(
            ((r.item, [w.encode() for w in r.words], r.whole) for r in rows), window
        )


SPANS = T.ArrayType(T.StructType([
    T.StructField("from_word", T.LongType()), T.StructField("to_word", T.LongType())]))


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, longest, spans (hit words, merged), items (ids as sorted strings);
    a row per row of ``docs`` (doc_id, text).

    NULL text and items have no words; an item without words is in no
    document.  A NULL item_id counts as the id ''.  Items of equal text are
    all found.  Rows that repeat are each answered; other columns are not
    read.  With no items nothing is hit; an empty table stays empty.
    """
    shared = _shared(docs, items, window)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("longest", T.LongType()),
        T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))])
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _found(batches, [a.value for a in shared]), schema)


def _shared(docs: DataFrame, items: DataFrame, window: int) -> list[Broadcast[SuffixAutomaton]]:
    """The shards' automata, built one after the other and broadcast."""
    return [docs.sparkSession.sparkContext.broadcast(a) for a in automata(items, window)]


def _found(batches: Iterator[pa.RecordBatch], shards: list[SuffixAutomaton]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [match(shards, t) for t in texts(batch.column("text"))]
        spans = [[{"from_word": x, "to_word": y} for x, y in m.spans] for m in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([m.n_words for m in rows], pa.int64()),
             pa.array([m.longest for m in rows], pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())]))),
             pa.array([sorted(m.items) for m in rows], pa.list_(pa.string()))],
            ["doc_id", "n_words", "longest", "spans", "items"])


def remove_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """``docs`` with the hit spans cut out of their texts, in the same columns.

    Cutting is repeated until no hit is left, as the ends of a cut may meet.
    A document of whose words more than ``max_coverage`` were cut goes.  Where
    there is a column n_chars it is set for changed texts.  Untouched rows are
    returned as they are, NULLs and repeated rows included.
    """
    shared = _shared(docs, items, window)
    words, hits = free_names(docs, "_leak_words", "_leak_hits")
    schema = T.StructType([*docs.schema.fields, T.StructField(words, T.LongType()), T.StructField(hits, T.LongType())])
    cut = docs.mapInArrow(lambda batches: _cut(batches, [a.value for a in shared], [words, hits]), schema)
    cut = cut.filter(F.col(hits) <= max_coverage * F.col(words))
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col(hits) > 0, changed).otherwise(F.col("n_chars")))
    return cut.select(*columns_of(docs))


def without_hits(shards: list[SuffixAutomaton], raw: bytes) -> tuple[bytes, int, int]:
    """A text without its hit spans, its words before, and how many were cut."""
    found = match(shards, raw)
    hits, n_words = 0, found.n_words
    while found.spans:
        hits += sum(b - a for a, b in found.spans)
        start, end, _ = word_spans(raw)
        kept, last = [], 0
        for a, b in found.spans:
            kept.append(raw[last:start[a]].rstrip(b" "))
            last = end[b - 1]
        raw = b"\n".join([*kept, raw[last:].lstrip(b" ")])
        found = match(shards, raw)
    return raw, n_words, hits


def _cut(
    batches: Iterator[pa.RecordBatch], shards: list[SuffixAutomaton], names: list[str]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        text = batch.column(at).to_pylist()
        words, hits = [], []
        for i, raw in enumerate(texts(batch.column(at))):
            raw, n, cut = without_hits(shards, raw)
            words.append(n)
            hits.append(cut)
            if cut:
                text[i] = raw.decode()
        field = batch.schema.field(at)
        batch = batch.set_column(at, field, pa.array(text, field.type))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(words, pa.int64()), pa.array(hits, pa.int64())], [*batch.schema.names, *names])

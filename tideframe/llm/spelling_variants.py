"""Spelling variants: words one edit apart, found by walking a trie with joins.

The trie is a distributed table of edges (node, label, child), one character or
more per label: nodes are prefixes at which at least two words part.  A state is
(word, position, node, edits).  Level by level the states are joined with the
edges of their node; at most one edit may be spent, and where an edge ends a
word, the states that spent theirs are neighbours.

Two words one edit apart share all of a half: either the beginning up to the
middle or the end from it.  So every word is walked twice, forwards and
reversed, each time from its own middle on; the crowded nodes near the root,
where every character has a sibling, are never expanded.  A pair is looked for
once: the longer word drops a character, or the one with the smaller character
replaces it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.llm.common import mix, texts, written

#: Shortest words, smallest count, and how many times as frequent a word's form is.
MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: A run whose checksum this divides loses a character.
MODULUS = 199
#: Different words a task holds before it passes their counts on.
HELD_WORDS = 200_000

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _counted(batches: Iterator[pa.RecordBatch], modulus: int, shortest: int) -> Iterator[pa.RecordBatch]:
    runs = re.compile("[A-Za-z\u00C0-\u00FF]{%d,}" % shortest)  # shorter runs give no word
    total: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for doc, raw in zip(ids, texts(batch.column("text"))):
            # the checksum of `<doc_id>:<run>`, continued from that of its beginning
            begin = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for run, n in Counter(runs.findall(raw.translate(_FOLD).decode())).items():
                h = zlib.crc32(run.encode(), begin)
                if h % modulus == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < shortest:
                        continue
                total[run] += n
            if len(total) > HELD_WORDS:
                yield out()
                total.clear()
    if total:
        yield out()


def vocabulary(
    docs: DataFrame, modulus: int = MODULUS, shortest: int = MIN_CHARS, min_count: int = MIN_COUNT
) -> DataFrame:
    """word, n: what the runs of letters of all texts become, with their counts."""
    counted = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _counted(batches, modulus, shortest), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of each word and of its reverse from the middle on: node, next character."""
    for batch in batches:
        ids = np.array(batch.column("id").to_pylist(), dtype=np.int64)
        words = batch.column("word").to_pylist()
        for side in (0, 1):
            text = "".join(w[::-1] for w in words) if side else "".join(words)
            code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
            size = np.array([len(w) for w in words], dtype=np.int64)
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            powers = np.full(int(size.max(initial=0)) + 1, _PRIME)
            powers[0] = 1
            powers = np.cumprod(powers)
            place = np.arange(len(code)) - np.repeat(first, size)
            run = np.zeros(len(code) + 1, dtype=np.uint64)
            run[1:] = np.cumsum((code + np.uint64(1)) * powers[place])
            # depths from the middle to the end of each word
            half = size // 2
            rows = size - half + 1
            owner = np.repeat(np.arange(len(words)), rows)
            depth = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(rows)[:-1]]), rows) + half[owner]
            at = first[owner] + depth
            node = mix(mix(run[at] - run[first[owner]]) ^ (depth.astype(np.uint64) * np.uint64(2) + np.uint64(side)))
            ends = depth == size[owner]
            follows = np.where(ends, 0, np.append(code, np.uint64(0))[at]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[owner]), pa.array(np.full(len(owner), side, dtype=np.int32)),
                pa.array(depth.astype(np.int32)), pa.array(node.view(np.int64)), pa.array(follows),
            ], ["id", "side", "depth", "node", "follows"])


def branching_paths(words: DataFrame) -> DataFrame:
    """id, side, s, n, nodes: each word with the nodes on its path at which words part.

    ``s`` is the word or its reverse.  Words without such a node are left out:
    nothing shares their half.
    """
    paths = words.select("id", "word").mapInArrow(_paths, "id long, side int, depth int, node long, follows int")
    parting = paths.groupBy("node").agg(F.min("follows").alias("a"), F.max("follows").alias("b")).filter("a <> b")
    nodes = paths.join(parting.select("node"), "node", "left_semi").groupBy("id", "side").agg(
        F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("nodes"))
    s = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))
    return nodes.join(words, "id").select("id", "side", s.alias("s"), "n", "nodes")


def _slice(s: str, after: Column, n: Column | None = None) -> Column:
    """n characters of ``s`` behind position ``after``; all without n."""
    rest = F.length(s) if n is None else n
    return F.substring(F.col(s), after + 1, rest)


def edge_table(paths: DataFrame) -> DataFrame:
    """node, label, child, and for an edge that ends a word: final (id), final_s, final_n."""
    at = F.posexplode("nodes").alias("i", "at")
    rows = paths.select("id", "s", "n", "nodes", at)
    following = F.when(F.col("i") + 1 < F.size("nodes"), F.element_at("nodes", F.col("i") + 2))
    rows = rows.withColumn("next", following)
    depth, ends = F.col("at.depth"), F.col("next").isNull()
    label = F.when(ends, _slice("s", depth)).otherwise(_slice("s", depth, F.col("next.depth") - depth))
    return rows.select(
        F.col("at.node").alias("node"), label.alias("label"), F.col("next.node").alias("child"),
        F.when(ends, F.col("id")).alias("final"), F.when(ends, F.col("s")).alias("final_s"),
        F.when(ends, F.col("n")).alias("final_n"),
    ).distinct()


def _moves() -> Column:
    """Where a state gets along an edge: an array of (position, edits)."""
    pos, label, size = F.col("pos"), F.col("label"), F.length("label")
    own, other = F.substring("s", F.col("pos") + 1, F.lit(1)), F.substring("label", 1, 1)

    def step(to: Column, edits: int) -> Column:
        return F.struct(to.cast("int").alias("to"), F.lit(edits).alias("spent"))

    same = _slice("s", pos, size) == label
    dropped = _slice("s", pos + 1, size) == label
    replaced = (other > own) & (own != "") & (
        _slice("s", pos + 1, size - 1) == F.substring(F.col("label"), F.lit(2), size))
    parts = (F.col("edits") == 0) & (own != other) & (own != "")
    return F.array_compact(F.array(
        F.when(same & ((F.col("edits") == 1) | F.col("child").isNotNull()),
               F.struct((pos + size).cast("int").alias("to"), F.col("edits").alias("spent"))),
        F.when(parts & dropped, step(pos + size + 1, 1)),
        F.when(parts & replaced, step(pos + size, 1)),
    ))


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one edge further, and the neighbours found (``final`` is set)."""
    met = states.join(edges, "node").withColumn("moves", _moves()).filter(F.size("moves") > 0)
    moved = met.select("id", "s", "n", "child", "final", "final_s", "final_n", F.inline("moves"))
    ended = F.col("final").isNotNull()
    return moved.filter(~ended | ((F.col("to") == F.length("s")) & (F.col("spent") == 1))).select(
        "id", "s", "n", F.col("to").alias("pos"), F.col("spent").alias("edits"),
        F.col("child").alias("node"), "final", "final_s", "final_n")


def near_pairs(words: DataFrame) -> DataFrame:
    """id, n, other, other_n, other_word of words (id, word, n) that are one edit apart, both ways."""
    paths = written(branching_paths(words), "spelling-paths")
    edges = written(edge_table(paths), "spelling-edges")
    start = F.element_at("nodes", 1)
    states = paths.select(
        "id", "s", "n", start["depth"].alias("pos"), F.lit(0).alias("edits"), start["node"].alias("node"))
    levels = []
    while True:
        level = written(_advance(states, edges), "spelling-level")
        levels.append(level.filter(F.col("final").isNotNull()))
        states = level.filter(F.col("final").isNull()).drop("final", "final_s", "final_n")
        if states.isEmpty():
            break
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    # nodes are named by hashes: only what is one edit apart as text counts
    found = found.filter(F.levenshtein("s", "final_s", 1) == 1).select("id", "n", "final", "final_n").distinct()
    return found.unionByName(found.select(
        F.col("final").alias("id"), F.col("final_n").alias("n"), F.col("id").alias("final"), F.col("n").alias("final_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): links are followed by doubling until none moves.

    A form is at least ``RATIO`` times as frequent as its word, so chains are
    as short as a logarithm and have no rings.
    """
    links = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = links.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        moved = written(moved, "spelling-roots")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return links


def spelling_variants(
    docs: DataFrame, modulus: int = MODULUS, shortest: int = MIN_CHARS,
    min_count: int = MIN_COUNT, ratio: int = RATIO,
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``docs`` (doc_id, text).

    Words are the runs of letters of whole texts, A-Z in lower case, after a
    hash of doc_id and run took a character from some; they have at least
    ``shortest`` characters and ``min_count`` occurrences.  ``form`` is the most
    frequent word one edit away (ties: first in code-point order) if it is at
    least ``ratio`` times as frequent.  NULL text has no words; a NULL doc_id
    hashes as empty text; rows that repeat a doc_id all count.  Other columns
    are not read.  An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its word")
    words = vocabulary(docs, modulus, shortest, min_count).withColumn("id", F.monotonically_increasing_id())
    words = written(words, "spelling-words")
    near = near_pairs(words)
    named = near.join(words.select(F.col("id").alias("final"), F.col("word").alias("other")), "final")
    best = named.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("final_n")).alias("less"), "other")).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    rows = words.join(best, "id", "left").select(
        "word", F.when(is_form, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.less")).alias("form_n"))
    rows = written(rows, "spelling-forms")
    roots = _roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

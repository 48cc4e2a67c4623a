"""Near-duplicates by order MinHash, verified by banded alignment.

A document is its sequence of five-word shingles, each labelled with how often
it occurred before.  For every one of ``SKETCHES`` hash functions the ``PICK``
labelled shingles of least hash are taken and hashed in text order: documents
agree in such a sketch when they share these shingles and their order, so the
chance of agreement follows edit similarity and not only common content.

Documents that agree in two (and in three) neighbouring sketches meet.  A
meeting of several classes has two hubs, others in each of ``TURNS`` turns.  In
the first turn a document is compared with one of the hubs it meets, then with
all of them: at most twice as many pairs as there are members.  A link stands when the two sequences align in at least ``SIMILAR`` of
their shingles; linked documents form a class.  Whatever still meets a document
of another class after the turns is compared with all that an exact prefix
filter over true shingle counts leaves; the turns save work and decide nothing.
Copies of a word sequence are one document throughout.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideframe.functions.joins import broadcast_if_small
from tideframe.llm.common import columns_of, mix, texts, word_hashes, written

SHINGLE = 5
SKETCHES = 32
PICK = 3
SIMILAR = 0.8
#: Neighbouring sketches that name a meeting.
DEPTHS = (2, 3)
#: Members of a meeting with whom the others are compared in a turn.
HUBS = 2
#: Turns of hubs before the exact rest; two at least, so that meetings of two are settled.
TURNS = 2
#: Lengths of documents are grouped by powers of this.
LENGTHS = 1.05

_RANDOM = np.random.Generator(np.random.PCG64(31))
_FACTORS = _RANDOM.integers(1, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CELLS = 2_000_000  # hash values held at once
_ROWS = 100_000  # rows of an output batch

ROW = "doc_id long, place binary, name long, n long, sketch array<long>"


def labelled_shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles in order, each with its occurrence number.

    All values differ.  Fewer than ``size`` words make one shingle.
    """
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(words))):
        s += words[k:k + n] * _PLACES[k]
    s = mix(s + np.uint64(min(size, len(words))))
    order = np.argsort(s, kind="stable")
    t = s[order]
    new = np.concatenate([[True], t[1:] != t[:-1]])
    if not new.all():
        at = np.arange(n)
        times = at - np.maximum.accumulate(np.where(new, at, 0))
        s[order] = mix(t + times.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return s


def sketches(shingles: np.ndarray) -> np.ndarray:
    """One hash per hash function: its least shingles, in text order."""
    pick = min(PICK, len(shingles))
    out = np.zeros(SKETCHES, dtype=np.uint64)
    step = max(1, _CELLS // len(shingles))
    for k in range(0, SKETCHES, step):
        h = shingles[None, :] * _FACTORS[k:k + step, None]
        if len(shingles) > pick:
            least = np.sort(np.argpartition(h, pick - 1, axis=1)[:, :pick], axis=1)
        else:
            least = np.broadcast_to(np.arange(pick), (len(h), pick))
        chosen = shingles[least]
        for i in range(pick):
            out[k:k + step] = mix(out[k:k + step] * np.uint64(31) + chosen[:, i])
    return out


def aligned(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> int:
    """Length of the longest common subsequence within the band that ``similar`` allows.

    Two sequences of that similarity differ in at most (n + m)(1 - s)/(1 + s)
    places, so no alignment of theirs leaves the band.  As every shingle is
    labelled, it has one partner at most, and the longest increasing run of
    partners is the alignment.
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = (len(a) + len(b)) * (1 - similar) / (1 + similar)
    near = np.abs(i - j) <= band
    j = j[near][np.argsort(i[near])]
    if len(j) < 2 or (np.diff(j) > 0).all():
        return len(j)
    tails: list[int] = []
    for x in j.tolist():
        k = bisect_left(tails, x)
        tails[k:k + 1] = [x]
    return len(tails)


def similarity(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> float:
    """Aligned shingles among all of both; 0 when one has too few for ``similar``."""
    if not len(a) or not len(b) or min(len(a), len(b)) < similar * max(len(a), len(b)):
        return 0.0
    same = aligned(a, b, similar)
    return same / (len(a) + len(b) - same)


def place(docs: DataFrame) -> Column:
    """A 128-bit hash of doc_id and text, by which a row is found again."""
    return F.unhex(F.md5(F.concat(
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit("|"), F.coalesce(docs["text"], F.lit("")))))


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, place, name (hash of the word sequence), n (shingles), sketch; a row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, n, out = [], [], []
            for raw in texts(b.column("text")):
                words = word_hashes(raw)
                names.append(int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little", signed=True))
                s = labelled_shingles(words)
                n.append(len(s))
                out.append(sketches(s).view(np.int64) if len(s) else np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("place"), pa.array(names, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(out, pa.list_(pa.int64()))],
                ["doc_id", "place", "name", "n", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), place(docs).alias("place"), "text")
    return rows.mapInArrow(run, ROW)


def meeting_keys(sketch: str = "sketch") -> Column:
    s = F.col(sketch)

    def key(depth: int, k: int) -> Column:
        return F.xxhash64(F.lit(depth * SKETCHES + k), *(s[(k + i) % SKETCHES] for i in range(depth)))

    return F.array(*(key(d, k) for d in DEPTHS for k in range(SKETCHES)))


def meetings(reps: DataFrame) -> DataFrame:
    """key, name, n: every meeting a document goes to."""
    return reps.select(F.explode(meeting_keys()).alias("key"), "name", "n")


def shared_meetings(reps: DataFrame) -> DataFrame:
    """The meetings of two or more."""
    met = meetings(reps)
    several = met.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("key")
    return met.join(several, "key").select("key", "name", "n")


def texts_of(docs: DataFrame, reps: DataFrame, shared: DataFrame) -> DataFrame:
    """name, text of every document that meets another: one pass over all texts."""
    needed = reps.join(shared.select("name").distinct(), "name").select("place", "name")
    return (
        docs.select(place(docs).alias("place"), "text").join(needed.hint("merge"), "place")
        .groupBy("place", "name").agg(F.any_value("text").alias("text")).select("name", "text")
    )


def with_roots(shared: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return shared.withColumn("root", F.col("name"))
    return shared.join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))


def candidates(shared: DataFrame, roots: DataFrame | None, turn: int, similar: float) -> DataFrame:
    """name, hub: whom to compare in this turn.

    Only meetings of several classes compare.  Each has HUBS hubs: the members
    least after an exclusive or with numbers that change every turn.  In the
    first turn, when every document is a class, each takes the least of its
    hubs, then all hubs of other classes.  Pairs whose lengths rule out
    ``similar`` are left out.
    """
    members = with_roots(shared, roots)
    masks = mix(np.arange(HUBS, dtype=np.uint64) + np.uint64(HUBS * turn + 1)).view(np.int64).tolist()
    least = [F.min(F.struct(F.col("name").bitwiseXOR(F.lit(m)).alias("x"), F.col("name").alias("hub"),
                            F.col("root").alias("hub_root"), F.col("n").alias("hub_n"))) for m in masks]
    hubs = (
        members.groupBy("key")
        .agg(F.array(*least).alias("hubs"), F.min("root").alias("a"), F.max("root").alias("b"))
        .filter("a <> b").select("key", F.inline("hubs")).drop("x").distinct()
    )
    pairs = members.join(hubs, "key").filter(
        (F.col("root") != F.col("hub_root")) & (F.least("n", "hub_n") >= similar * F.greatest("n", "hub_n"))
    )
    if roots is None:
        return pairs.groupBy("name").agg(F.min("hub").alias("hub"))
    return pairs.select("name", "hub").distinct()


def links(pairs: DataFrame, texts_by_name: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """name, hub of the pairs whose alignment holds.

    Only texts of documents in ``pairs`` are shuffled; the rest is left out by a
    join that needs no shuffle when the names are measured to be few.
    """
    pairs = written(pairs, "near-pairs")
    names = broadcast_if_small(pairs.select("name").union(pairs.select("hub")).distinct())
    own = texts_by_name.join(names, "name", "left_semi")
    both = pairs.join(own, "name").join(own.toDF("hub", "hub_text").hint("merge"), "hub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub_shingles = None, np.zeros(0, dtype=np.uint64)
        for b in batches:
            keep = []
            hubs = b.column("hub").to_pylist()
            for raw, hub, hub_raw in zip(texts(b.column("text")), hubs, texts(b.column("hub_text"))):
                if hub != last:
                    last, hub_shingles = hub, labelled_shingles(word_hashes(hub_raw))
                keep.append(similarity(labelled_shingles(word_hashes(raw)), hub_shingles, similar) >= similar)
            yield b.select(["name", "hub"]).filter(pa.array(keep, pa.bool_()))

    return both.select("name", "hub", "text", "hub_text").mapInArrow(run, "name long, hub long")


def unsettled(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """name, root of the members of meetings that hubs cannot settle: of several
    classes and more than two members.  Of two, one was the other's hub."""
    members = with_roots(shared, roots)
    several = (
        members.groupBy("key")
        .agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("a"), F.max("root").alias("b"))
        .filter("members > 2 and a <> b").select("key")
    )
    return members.join(several, "key").select("name", "root").distinct()


def prefix_lengths(n, similar: float, ceil=math.ceil) -> tuple:
    """How many of its rarest shingles a document of n (a number, or a column
    with ``F.ceil``) needs as the shorter and as the longer of a pair: two that
    are similar have one of these in common.

    They share at least s of the longer's shingles, and 2s/(1 + s) of the shorter's.
    """
    shorter, longer = (n - ceil(n * share - 1e-6) + 1 for share in (2 * similar / (1 + similar), similar))
    return shorter, longer


def shingles_of(text: DataFrame) -> DataFrame:
    """shingle, name, root, n: every labelled shingle of every text."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        each = [len(r[0]) for r in rows]
        names, roots = (np.repeat(np.array([r[k] for r in rows], dtype=np.int64), each) for k in (1, 2))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([r[0] for r in rows]).view(np.int64)), pa.array(names), pa.array(roots),
             pa.array(np.repeat(np.array(each, dtype=np.int64), each))],
            ["shingle", "name", "root", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for raw, name, root in zip(texts(b.column("text")), b.column("name").to_pylist(), b.column("root").to_pylist()):
                rows.append((labelled_shingles(word_hashes(raw)), name, root))
                held += len(rows[-1][0])
                if held >= _ROWS:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    return text.select("text", "name", "root").mapInArrow(run, "shingle long, name long, root long, n long")


def rarest_shingles(shingles: DataFrame, similar: float) -> DataFrame:
    """shingle, name, root, n, at, short: the prefixes of the documents.

    A document's shingles are ranked alike everywhere: those of a single class
    first, as nobody else has them, then from rare to common by their true
    counts.  ``at`` is the rank from 0; ``short`` tells whether it counts for
    the shorter of a pair.
    """
    counts = (
        shingles.groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("times"), F.min("root").alias("a"), F.max("root").alias("b"))
        .filter("a <> b").select("shingle", "times")
    )
    whole = Window.partitionBy("name")
    alone = F.col("n") - F.count(F.lit(1)).over(whole)
    shorter, longer = prefix_lengths(F.col("n"), similar, F.ceil)
    return (
        shingles.join(counts, "shingle")
        .withColumn("at", alone + F.row_number().over(whole.orderBy("times", "shingle")) - 1)
        .filter(F.col("at") < longer)
        .select("shingle", "name", "root", "n", "at", (F.col("at") < shorter).alias("short"))
    )


def remaining(text: DataFrame, similar: float) -> DataFrame:
    """name, hub: every pair of different classes of ``text`` (text, name, root) that can be similar.

    A pair is left out when no shingle of its prefixes is common, or when too
    few follow it; neither happens to a similar pair.  Both sides meet by
    shingle and group of lengths, so a longer document only goes where the
    rank of the shingle allows a partner.
    """
    rare = written(rarest_shingles(written(shingles_of(text), "near-shingles"), similar), "near-rarest")

    def group(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / F.log(F.lit(LENGTHS)))

    m = F.col("hub_n")
    low = F.ceil(m * similar - 1e-6)
    high = F.least(m, F.floor(((m - F.col("hub_at")) * (1 + similar) + 1e-6) / similar - m))
    longer = (
        rare.drop("short").toDF("shingle", "hub", "hub_root", "hub_n", "hub_at").filter(high >= low)
        .withColumn("lengths", F.explode(F.sequence(group(low), group(high))))
    )
    follow = F.least(F.col("n") - F.col("at"), m - F.col("hub_at"))
    pairs = rare.filter("short").withColumn("lengths", group(F.col("n"))).join(longer, ["shingle", "lengths"]).filter(
        (F.col("root") != F.col("hub_root")) & (F.col("n") <= m) & (F.col("n") + 1e-6 >= similar * m)
        & (follow * (1 + similar) + 1e-6 >= similar * (F.col("n") + m))
    )
    return pairs.select(F.least("name", "hub").alias("name"), F.greatest("name", "hub").alias("hub")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """name, root of every linked document: the least name it is connected with.

    Labels spread to neighbours and jump to their label's label; each round is
    written, so a lost executor costs one round.  Chains of hubs are short,
    and rounds grow with their logarithm.
    """
    both = written(edges.union(edges.select("hub", "name")).toDF("name", "other").distinct(), "near-edges")
    labels = both.groupBy("name").agg(F.min("other").alias("root"))
    labels = written(labels.select("name", F.least("name", "root").alias("root")), "near-labels")
    none = F.lit(None).cast("long")
    while True:
        told = both.join(labels.toDF("other", "root"), "other").select("name", "root", none.alias("old"))
        least = (
            told.union(labels.select("name", "root", F.col("root").alias("old")))
            .groupBy("name").agg(F.min("root").alias("least"), F.max("old").alias("old"))
        )
        jumped = least.join(labels.toDF("least", "further"), "least", "left")
        new = written(
            jumped.select("name", F.least("least", F.coalesce("further", "least")).alias("root"), "old"),
            "near-labels",
        )
        labels = new.select("name", "root")
        if new.filter("root < old").isEmpty():
            return labels


def classes(docs: DataFrame, reps: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """name, root of every document that is linked with another."""
    shared = written(shared_meetings(reps), "near-meetings")
    text = written(texts_of(docs, reps, shared), "near-texts")
    roots = edges = None
    for turn in range(TURNS):
        found = written(links(candidates(shared, roots, turn, similar), text, similar), "near-links")
        edges = found if edges is None else edges.union(found)
        roots = components(edges)
    rest = written(text.join(unsettled(shared, roots), "name"), "near-unsettled")
    found = written(links(remaining(rest, similar), text, similar), "near-links")
    return roots if found.isEmpty() else components(edges.union(found))


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id, class_size, kept, place of every row of ``docs`` (doc_id, text).

    class_id is the smallest doc_id of the row's class; that row is kept.  A
    row without words (NULL, empty, signs only) is a class of its own.  Rows
    that repeat a doc_id and text count in class_size, and one of them can be
    kept; so can one of several NULL doc_ids that are a class by themselves.
    Other columns are not read.  An empty table stays empty.
    """
    docs = docs.select("doc_id", "text")
    rows = written(sketched(docs), "sketches")
    worded = rows.filter("n > 0")
    reps = written(worded.dropDuplicates(["name"]).select("name", "place", "n", "sketch"), "representatives")
    roots = classes(docs, reps, similar)
    members = (
        worded.groupBy("name", "doc_id", "place").agg(F.count(F.lit(1)).alias("rows"))
        .join(roots, "name", "left")
        .select(F.coalesce("root", "name").alias("root"), "doc_id", "place", "rows")
    )
    members = written(members, "near-members")
    heads = members.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.sum("rows").alias("class_size"))
    # Of several texts under the doc_id that stays, one.
    first = (
        members.join(heads, "root").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy("root").agg(F.min("place").alias("stays"))
    )
    found = (
        members.join(heads.join(first, "root"), "root")
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .select("doc_id", "class_id", "class_size",
                ((F.col("place") == F.col("stays")) & (F.col("nth") == 1)).alias("kept"), "place")
    )
    alone = rows.filter("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"), "place")
    return found.unionByName(alone)


#: A character of a word, see ``word_hashes``.
_WORDED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def drop_near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one row of each class, and all rows without words.

    Of rows that are equal in doc_id and text one stays, whichever their other
    columns.  The columns are those of ``docs``, whatever their names.
    """
    worded = F.coalesce(docs["text"], F.lit("")).rlike(_WORDED)
    stays = near_duplicates(docs, similar).filter("kept").select("place").distinct()
    rows = docs.filter(worded).select(place(docs).alias("place"), F.struct(*columns_of(docs)).alias("row"))
    one = rows.join(stays, "place", "left_semi").groupBy("place").agg(F.any_value("row").alias("row"))
    return one.select("row.*").unionByName(docs.filter(~worded))

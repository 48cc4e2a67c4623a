"""Resampling documents towards the word statistics of a target table.

Features are runs of one and two words; their CRC-32 names a bucket.  CRC-32 is
linear but for a constant: every byte contributes a value that depends on the
byte and on its distance from the end of the feature only.  These values come
from one table, and a feature's checksum is the XOR of its bytes' values
(``bitwise_xor.reduceat`` over the spans) and a constant of its length.
Features beyond the table are folded from blocks of its width.

Bucket counts leave a task as at most one row per bucket.  Scores are ranked by
a range-partitioned sort and the sizes of its partitions: no task sees them all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.llm.common import pieces, texts, word_spans, written

#: Width of the position table in bytes.
WIDTH = 256
#: Bytes of text handled at once; a longer word is never cut.
CHUNK = 1 << 20
BUCKETS = 10_000
SHARE, MIN_WORDS, SEED = 25, 20, 7


def _position_table(width: int) -> np.ndarray:
    """[distance from the end, byte] -> contribution to the checksum."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    rows = [step]
    for _ in range(width - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ step[rows[-1] & np.uint32(0xFF)])
    return np.array(rows, dtype=np.uint32)


POSITION = _position_table(WIDTH)
_FLAT = POSITION.reshape(-1)
#: Checksum of n zero bytes, for n up to the width.
LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(WIDTH + 1)], dtype=np.uint32)


def _applied(shift: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The linear map ``shift`` ([byte of the state, value] -> state) of states x."""
    out = shift[0][x & np.uint32(0xFF)]
    for k in range(1, 4):
        out = out ^ shift[k][(x >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


@lru_cache(maxsize=64)
def shift_table(power: int) -> np.ndarray:
    """What 2^power further zero bytes do to a state."""
    if power:
        half = shift_table(power - 1)
        return np.array([_applied(half, row) for row in half])
    states = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return (states >> np.uint32(8)) ^ POSITION[0][states & np.uint32(0xFF)]


def shifted(x: int, n: int) -> int:
    """A state after n further zero bytes."""
    at, power = np.array([x], dtype=np.uint32), 0
    while n >> power:
        if n >> power & 1:
            at = _applied(shift_table(power), at)
        power += 1
    return int(at[0])


def long_checksum(data: np.ndarray, block: int = 1 << 16) -> int:
    """CRC-32 of any number of bytes, from blocks folded in pairs."""
    state = 0
    for i in range(0, len(data), block):
        part = data[i:i + block]
        pad = -len(part) % WIDTH  # zero bytes in front contribute nothing
        rows = np.concatenate([np.zeros(pad, dtype=np.uint8), part]).reshape(-1, WIDTH)
        at = np.arange(WIDTH - 1, -1, -1) * 256 + rows
        values, power = np.bitwise_xor.reduce(_FLAT[at], axis=1), WIDTH.bit_length() - 1
        while len(values) > 1:
            if len(values) % 2:
                values = np.concatenate([np.zeros(1, dtype=np.uint32), values])
            values = _applied(shift_table(power), values[0::2]) ^ values[1::2]
            power += 1
        state = shifted(state, len(part)) ^ int(values[0])
    return state ^ shifted(0xFFFFFFFF, len(data)) ^ 0xFFFFFFFF


def checksums(start: np.ndarray, end: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each word, and of each word with a space and the next word."""
    size = end - start
    if not len(size):
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint32)
    # words with one space behind each
    room = size + 1
    first = np.concatenate([[0], np.cumsum(room)[:-1]])
    place = np.arange(int(room.sum())) - np.repeat(first, room)
    is_space = place == np.repeat(size, room)
    body = np.where(is_space, 0x20, b[np.minimum(np.repeat(start, room) + place, len(b) - 1)]).astype(np.int64)
    # a word's bytes, counted from its end
    far = np.repeat(size, room) - 1 - place
    value = _FLAT[(np.clip(far, 0, WIDTH - 1) << 8) | body]
    value[is_space] = 0
    own = np.bitwise_xor.reduceat(value, first)
    ones = own ^ LENGTH[np.minimum(size, WIDTH)]
    # the same and its space, counted from the end of the next word
    after = np.concatenate([size[1:], [0]])
    far += np.repeat(after, room) + 1
    value = _FLAT[(np.clip(far, 0, WIDTH - 1) << 8) | body]
    whole = size[:-1] + 1 + size[1:]
    twos = np.bitwise_xor.reduceat(value, first)[:-1] ^ own[1:] ^ LENGTH[np.minimum(whole, WIDTH)]
    for i in np.flatnonzero(size > WIDTH):
        ones[i] = long_checksum(b[start[i]:end[i]])
    space = np.array([0x20], dtype=np.uint8)
    for i in np.flatnonzero(whole > WIDTH):
        twos[i] = long_checksum(np.concatenate([b[start[i]:end[i]], space, b[start[i + 1]:end[i + 1]]]))
    return ones, twos


def features(bodies: list[bytes], limit: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, checksum) of every feature, a bounded part of them at a time."""
    numbers: list[int] = []
    parts: list[bytes] = []
    held = 0

    def done() -> tuple[np.ndarray, np.ndarray]:
        begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])[:-1]])
        start, end, b = word_spans(b"\n".join(parts))
        part = np.searchsorted(begins, start, side="right") - 1
        owner = np.array(numbers, dtype=np.int64)[part]
        ones, twos = checksums(start, end, b)
        within = owner[1:] == owner[:-1]
        # a word repeated from the part before only takes part in a pair
        known = np.zeros(len(start), dtype=bool)
        for p in repeated:
            known[np.flatnonzero(part == p)[:1]] = True
        return (np.concatenate([owner[~known], owner[:-1][within]]),
                np.concatenate([ones[~known], twos[within]]))

    repeated: list[int] = []
    for i, body in enumerate(bodies):
        tail = b""  # the last word so far
        for piece in pieces(body, limit):
            if held + len(piece) > limit and parts:
                yield done()
                numbers, parts, repeated, held = [], [], [], 0
            # parts of one text that lie side by side meet at the line end between them
            if tail and not (numbers and numbers[-1] == i):
                repeated.append(len(parts))
                piece = tail + b" " + piece
            numbers.append(i)
            parts.append(piece)
            held += len(piece) + 1
            start, end, b = word_spans(piece)
            if len(start):
                tail = b[start[-1]:end[-1]].tobytes()
    if parts:
        yield done()


def _counts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for _, sums in features(texts(batch.column("text"))):
            total += np.bincount(sums % np.uint32(buckets), minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int64()), "n": pa.array(total[held], pa.int64())})


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: the features of all texts, at most one row per bucket and task before the shuffle."""
    counted = docs.select("text").mapInArrow(lambda batches: _counts(batches, buckets), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket.  The driver takes one number per bucket and table."""
    def vector(rows: DataFrame) -> list[int]:
        n = [0] * buckets
        for r in bucket_counts(rows, buckets).collect():
            n[r.bucket] = r.n
        return n

    have, want = vector(docs), vector(target)
    all_have, all_want = sum(have), sum(want)
    return np.array([
        int(1000 * log((t + 1) * (all_have + buckets) / ((s + 1) * (all_want + buckets))) // 1)
        for s, t in zip(have, want)], dtype=np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Floored noise from a hash of the doc_id; NULL counts as empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def importance(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            bodies = texts(batch.column("text"))
            n, total = np.zeros((2, len(bodies)), dtype=np.int64)
            for owner, sums in features(bodies):
                n += np.bincount(owner, minlength=len(bodies))
                # np.add.at keeps whole numbers
                np.add.at(total, owner, own[sums % np.uint32(len(own))])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                ["doc_id", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {kind}, n_features long, weight long")
    return rows.select(
        "doc_id", F.floor((F.col("n_features") + 1) / 2).cast("long").alias("n_words"), "n_features", "weight",
        (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
    )


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``nth``, 1, 2, 3... in the given order, and ``n_all``.

    Rows are sorted over ranges and written with their place in the range;
    sizes of the ranges before, one number per partition, make it a rank.
    """
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    placed = written(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    starts = placed.sparkSession.createDataFrame(before, "part long, before long")
    return placed.withColumn("part", part).join(F.broadcast(starts), "part").select(
        *rows.columns, (F.col("before") + place + 1).alias("nth"), F.lit(total).cast("long").alias("n_all"))


def importance_resample(
    docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank: one row per row of ``docs`` (doc_id, text).

    ``rank`` numbers the drawn documents by falling score, ties by doc_id; it is
    NULL for all others.  Of the N documents of at least ``min_words`` words,
    floor(share * N / 100) are drawn.  NULL text has no words, no features and
    weight 0.  A NULL doc_id hashes as empty text and comes last among ties;
    rows that repeat a doc_id are each scored and ranked, equal ones in any
    order.  Other columns are not read.  An empty table gives an empty result;
    an empty target makes all gains those of unseen words.
    """
    rows = written(importance(docs, gains(docs, target, buckets), seed), "importance")
    fit = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    drawn = ranked(rows.filter(fit), order)
    rank = F.when(F.col("nth") <= F.floor(F.col("n_all") * share / 100), F.col("nth"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return drawn.select(*columns, rank.alias("rank")).unionByName(
        rows.filter(~fit).select(*columns, F.lit(None).cast("long").alias("rank")))

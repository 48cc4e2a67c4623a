"""Token files as directly addressable codes.

Ids are split into chunks of eight bits.  Level 0 holds the low chunk of every
id and a bitmap telling which ids go on; level 1 holds the next chunk of those
that do, and so on.  A rank directory over each bitmap (ones before every block
of 512 bits) finds an id's place on the next level, so any token is read
without decoding its neighbours.

A segment is such a code over some million tokens, with the table of its
documents.  Segments are rows of a Parquet table in ascending order of doc_id,
written by Spark on the executors, so any store Spark can write to will do and
a lost task leaves nothing behind.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = 1
SEGMENT_TOKENS = 1_000_000
MAGIC = b"TDAC0001"
BLOCK = 512  # bits of a bitmap per entry of its rank directory
HEADER = struct.Struct("<8sIIB3x")  # magic, tokens, documents, levels
#: Words whose ids a task remembers, and the longest of these.
MEMO_WORDS, MEMO_CHARS = 500_000, 64

SEGMENTS = ("part int, segment int, first_token long, n_docs long, n_tokens long,"
            " first_doc long, last_doc long, data binary")


def default_tokenizer() -> str:
    """The word tokenizer of the installed vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_segment(ids: np.ndarray, docs: list[int | None], sizes: list[int]) -> bytes:
    """The bytes of a segment: header, documents, levels."""
    ids = ids.astype(np.uint32)
    levels, rest = [], ids
    while True:
        on = rest > 0xFF
        bits = np.packbits(on, bitorder="little")
        blocks = np.add.reduceat(on, np.arange(0, len(on), BLOCK)) if len(on) else np.zeros(0)
        ranks = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u4") if len(on) else np.zeros(0, "<u4")
        levels.append(struct.pack("<I", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes()
                      + bits.tobytes() + ranks.tobytes())
        if not on.any():
            break
        rest = rest[on] >> np.uint32(8)
    null = np.array([d is None for d in docs], dtype=np.uint8)
    numbers = np.array([d or 0 for d in docs], dtype="<i8")
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<u4")
    return b"".join([HEADER.pack(MAGIC, len(ids), len(docs), len(levels)),
                     numbers.tobytes(), null.tobytes(), starts.tobytes(), *levels])


class Segment:
    """Reads a packed segment.  Nothing is decoded on opening."""

    def __init__(self, data: bytes):
        magic, self.n_tokens, self.n_docs, levels = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self._at = HEADER.size

        def take(n: int, kind: str) -> np.ndarray:
            x = np.frombuffer(data, dtype=kind, count=n, offset=self._at)
            self._at += x.nbytes
            return x

        numbers, null = take(self.n_docs, "<i8"), take(self.n_docs, "u1")
        self.docs = [None if z else d for d, z in zip(numbers.tolist(), null.tolist())]
        self.starts = take(self.n_docs + 1, "<u4")
        self.levels = []
        for _ in range(levels):
            n = int(take(1, "<u4")[0])
            self.levels.append((take(n, "u1"), take(-(-n // 8), "u1"), take(-(-n // BLOCK), "<u4")))

    def token(self, i: int) -> int:
        """The i-th id, from one chunk per level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            begin = i // BLOCK * BLOCK
            ones = np.unpackbits(bits[begin // 8:i // 8 + 1], bitorder="little")[: i - begin].sum()
            i, shift = int(ranks[i // BLOCK]) + int(ones), shift + 8
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        below = np.zeros(0, dtype=np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            on = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            value = chunks.astype(np.uint32)
            value[on] |= below << np.uint32(8)
            below = value
        return below


class WordIds(dict):
    """Ids (as bytes) of words: what stands between two blanks.

    Right for tokenizers that never look past white space, lower their texts
    and cut words where letters end.  A plain word, lower-case letters of
    Latin-1 and then signs, is encoded as its letters by the tokenizer's own
    model and its signs; any other word by the whole tokenizer.
    """

    PLAIN = re.compile(r"([a-z\xdf-\xf6\xf8-\xff]+)([!-/:-@\[-`{-~]*)")
    #: Byte-level form of a text: bytes that print stand for themselves.
    BYTES = {b: 256 + k for k, b in enumerate(
        b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        plain = self.PLAIN.fullmatch(word)
        if plain is None or len(word) > MEMO_CHARS:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        elif plain[2]:
            ids = self[plain[1]] + self._signs(plain[2])
        else:
            known = self.model.tokenize(word.encode().decode("latin-1").translate(self.BYTES))
            ids = array("I", [t.id for t in known]).tobytes()
        if len(word) <= MEMO_CHARS:
            self[word] = ids
        return ids

    def _signs(self, signs: str) -> bytes:
        if signs not in self:
            self[signs] = array("I", self.tokenizer.encode(signs, add_special_tokens=False).ids).tobytes()
        return self[signs]

    def encode(self, text: str) -> np.ndarray:
        if len(self) > MEMO_WORDS:
            self.clear()
            self[""] = b""
        if "<|" not in text:  # the special tokens are told by their case
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:  # the tokenizer lowers some other letters its own way
                pass
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype="<u4")


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One memory per Python worker, whatever the number of its tasks."""
    return WordIds(path)


def _segments(batches: Iterator[pa.RecordBatch], path: str, end: int, limit: int) -> Iterator[pa.RecordBatch]:
    words, part = word_ids(path), TaskContext.get().partitionId()
    docs: list[int | None] = []
    ids: list[np.ndarray] = []
    held = segment = first = 0

    def row() -> pa.RecordBatch:
        data = pack_segment(np.concatenate(ids), docs, [len(x) for x in ids])
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([first], pa.int64()),
            pa.array([len(docs)], pa.int64()), pa.array([held], pa.int64()), pa.array([docs[0]], pa.int64()),
            pa.array([docs[-1]], pa.int64()), pa.array([data], pa.binary()),
        ], ["part", "segment", "first_token", "n_docs", "n_tokens", "first_doc", "last_doc", "data"])

    tail = np.array([end], dtype="<u4")
    for batch in batches:
        bodies, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
        for d, text in zip(keys, bodies):
            docs.append(d)
            ids.append(np.concatenate([words.encode(text or ""), tail]))
            held += len(ids[-1])
            if held >= limit:
                yield row()
                first, segment = first + held, segment + 1
                docs, ids, held = [], [], 0
    if docs:
        yield row()


def write_tokens(
    docs: DataFrame, out: str, tokenizer: str, end: int = END, segment_tokens: int = SEGMENT_TOKENS,
    as_they_come: bool = False,
) -> None:
    """Writes the ids of all texts, each with ``end`` after it, in ascending doc_id order.

    ``as_they_come`` writes the rows in the order of their partitions instead,
    without a shuffle: for a corpus that was shuffled on purpose.

    NULL text is empty: its only id is ``end``.  NULL doc_ids come first; rows
    that repeat a doc_id are each written, ordered by a hash of their text.
    Other columns are not read.  An empty table writes a table of no segments.
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not as_they_come:
        ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(
        lambda batches: _segments(batches, tokenizer, end, segment_tokens), SEGMENTS
    ).write.parquet(out)


def _documents(batches: Iterator[pa.RecordBatch], base: dict[int, int], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, first, data in zip(*(batch.column(c).to_pylist() for c in ("part", "first_token", "data"))):
            s = Segment(data)
            ids, starts = s.ids(), s.starts.astype(np.int64)
            own = [ids[a:b] for a, b in zip(starts[:-1], starts[1:])]
            columns = {
                "doc_id": pa.array(s.docs, pa.int64()),
                "start": pa.array(starts[:-1] + first + base[part], pa.int64()),
                "n_tokens": pa.array(np.diff(starts), pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, from the files at ``path``.

    ``start`` counts the ids of all documents before.  For it the driver adds
    up one number per write task.
    """
    table = spark.read.schema(SEGMENTS).parquet(path)
    base, total = {}, 0
    for part, n in sorted(table.groupBy("part").agg(F.sum("n_tokens")).collect()):
        base[part], total = total, total + n
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return table.select("part", "first_token", "data").mapInArrow(
        lambda batches: _documents(batches, base, with_ids), kind
    )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """position, token: single tokens of the whole stream, read in place.

    ``positions`` has one column of global positions; each is looked up in the
    one segment that holds it, by chunks and ranks only.  Positions outside
    are left out.
    """
    table = spark.read.schema(SEGMENTS).parquet(path)
    base, total = {}, 0
    for part, n in sorted(table.groupBy("part").agg(F.sum("n_tokens")).collect()):
        base[part], total = total, total + n
    begin = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])[F.col("part")] if base else F.lit(0)
    begin = (F.col("first_token") + begin).cast("long")
    step = SEGMENT_TOKENS  # segments and positions meet in the slots of this width that they touch
    slots = F.sequence(F.floor(F.col("begin") / step), F.floor((F.col("begin") + F.col("n_tokens") - 1) / step))
    segments = table.withColumn("begin", begin).withColumn("slot", F.explode(slots))
    wanted = positions.select(F.col(positions.columns[0]).cast("long").alias("position"))
    wanted = wanted.withColumn("slot", F.floor(F.col("position") / step))
    held = (F.col("position") >= F.col("begin")) & (F.col("position") < F.col("begin") + F.col("n_tokens"))
    hits = wanted.join(segments, "slot").filter(held)
    hits = hits.groupBy("part", "segment", "begin").agg(
        F.collect_set("position").alias("positions"), F.any_value("data").alias("data"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, places, data in zip(*(batch.column(c).to_pylist() for c in ("begin", "positions", "data"))):
                s = Segment(data)
                yield pa.RecordBatch.from_pydict({
                    "position": pa.array(places, pa.int64()),
                    "token": pa.array([s.token(p - begin) for p in places], pa.int32())})

    return hits.mapInArrow(look, "position long, token int")

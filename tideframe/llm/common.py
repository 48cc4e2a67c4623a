"""What several operators share: table access, written intermediates, word hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.session import tune, work_folder

#: Rows of an Arrow batch.
BATCH_ROWS = 1000

#: A word: digits, lower-case a-z, and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: A-Z to a-z; other letters stay as they are.
LOWER = {c: c + 32 for c in range(65, 91)}

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = True
_IS_WORD[0x61:0x7B] = True
_IS_WORD[0x80:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` from a table in the shared work folder: computed once, and still
    there when an executor is lost."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened by underscores until no column of ``df`` is called so, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    """Its columns by name, whatever characters are in these."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix64's published constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2^64."""
    global _POWERS
    while len(_POWERS) < n:
        last = _POWERS[-1:] * np.uint64(0x9E3779B97F4A7C15)
        _POWERS = np.concatenate([_POWERS, _POWERS * last])
    return _POWERS[:n]


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words of a UTF-8 text, and its folded bytes."""
    b = _FOLD[np.frombuffer(raw, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(_IS_WORD[b], prepend=False, append=False))
    return edge[::2], edge[1::2], b


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order. Equal words have equal hashes."""
    start, end, b = word_spans(raw)
    return hash_spans(start, end, b)


def hash_spans(start: np.ndarray, end: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    length = end - start
    inside = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    at = np.arange(int(length.sum())) + inside
    place = at - np.repeat(start, length)
    value = _BYTE[b[at]] * _powers(int(length.max()))[place]
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    return mix(np.add.reduceat(value, first))


def session(spark: SparkSession) -> SparkSession:
    """Adaptive plans, and small Arrow batches: a batch of long texts has to fit in memory."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(raw: bytes, limit: int) -> Iterator[bytes]:
    """A text cut behind blanks into parts of about ``limit`` bytes; a longer word stays whole."""
    blanks, at = (b" ", b"\t", b"\n", b"\r"), 0
    while len(raw) - at > limit:
        cut = max(raw.rfind(c, at, at + limit) for c in blanks)
        if cut < 0:
            cut = min((c for c in (raw.find(x, at + limit) for x in blanks) if c >= 0), default=len(raw) - 1)
        yield raw[at:cut + 1]
        at = cut + 1
    yield raw[at:]

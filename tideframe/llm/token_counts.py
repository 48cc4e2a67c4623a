"""Token counts of whole texts, on the map side only.

Tier one is a compact hash table of frequent pre-tokens and their numbers of
tokens, broadcast once and looked up for a whole chunk of text at a time.  What
it does not hold goes to tier two, a memory per Python worker, and from there to
the tokenizer.  No pre-token is ever shuffled.

A *unit* is what the tables are keyed by: in plain words (ASCII, and letters of
Latin-1 written as one character) the tokenizer's own pre-tokens, that is a run
of letters, a digit, or a run of signs; any other word between blanks is one
unit.  The tokenizer never looks past white space, so counts of units add up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.llm.common import mix, pieces, texts
from tideframe.llm.token_files import default_tokenizer

#: Documents (expected number) whose units choose the table; it decides speed, never counts.
SAMPLE = 2_000
#: Units of the table, and the longest of them in bytes.
TABLE_UNITS, KEY_BYTES = 32_768, 16
#: Tasks that look at the sample: each sends at most ``TABLE_UNITS`` rows to the driver.
SAMPLE_PARTS = 8
#: Units a worker remembers, and the longest of them in bytes.
MEMO_UNITS, MEMO_BYTES = 500_000, 64
#: Bytes of text handled at once; a longer word is never cut.
CHUNK = 1 << 20
#: Tokens above which a document is over the limit.
LIMIT = 2_048

SPACE, LETTER, DIGIT, SIGN, ODD = range(5)

_CLASS = np.full(256, ODD, dtype=np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
_CLASS[0x21:0x7F] = SIGN
_CLASS[0x30:0x3A] = DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = LETTER
_CLASS[0x27] = ODD  # an apostrophe may begin a contraction
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

Units = tuple[np.ndarray, np.ndarray, np.ndarray]


def units_of(raw: bytes) -> Units:
    """Starts and ends of the units of a text, and its bytes, plain words in lower case."""
    b = np.frombuffer(raw, dtype=np.uint8)
    kind = _CLASS[b]
    lead = np.flatnonzero(b[:-1] == 0xC3)
    lead = lead[(b[lead + 1] != 0x97) & (b[lead + 1] != 0xB7)]  # the signs of Latin-1's upper half
    kind[lead] = kind[lead + 1] = LETTER
    special = np.flatnonzero((b[:-1] == 0x3C) & (b[1:] == 0x7C))  # begins a special token
    kind[special] = ODD
    space = kind == SPACE
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    begin, stop = edge[::2], edge[1::2]
    if not len(begin):
        return begin, stop, b
    odd = np.zeros(len(b), dtype=bool)
    has_odd = np.add.reduceat((kind == ODD).astype(np.int32), begin) > 0
    if has_odd.any():
        rise = np.zeros(len(b) + 1, dtype=np.int8)
        rise[begin[has_odd]] += 1
        rise[stop[has_odd]] -= 1
        odd = np.cumsum(rise[:-1], dtype=np.int8) > 0
    opens = np.empty(len(b), dtype=bool)
    opens[0] = False
    opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    opens &= ~odd & ~space
    opens[begin] = True
    last = ~space
    last[:-1] &= opens[1:] | space[1:]
    return np.flatnonzero(opens), np.flatnonzero(last) + 1, np.where(odd, b, _FOLD[b])


def keys_of(start: np.ndarray, end: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of each unit as two numbers, and whether they name it.

    Units that are too long or hold a zero byte have no such name.
    """
    padded = np.concatenate([b, np.zeros(KEY_BYTES, dtype=np.uint8)])
    eight = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded.data, strides=(1,))
    size = end - start
    low = eight[start] & _KEEP[np.minimum(size, 8)]
    high = eight[np.minimum(start + 8, len(eight) - 1)] & _KEEP[np.clip(size - 8, 0, 8)]
    named = size <= KEY_BYTES
    if (b == 0).any():
        named &= np.add.reduceat((b == 0).astype(np.int32), start) == 0
    return low, high, named


class LengthTable:
    """Open addressing over numpy arrays: 18 bytes per slot, at least half the slots free."""

    def __init__(self, sizes: dict[bytes, int]):
        units = [u for u in sizes if 0 < len(u) <= KEY_BYTES and 0 not in u and sizes[u] < 0xFFFF]
        slots = 1 << max(4, (2 * len(units)).bit_length())
        self.mask = np.uint64(slots - 1)
        self.low, self.high = np.zeros(slots, dtype=np.uint64), np.zeros(slots, dtype=np.uint64)
        self.size = np.zeros(slots, dtype=np.uint16)  # tokens and 1; 0 is a free slot
        for u in units:
            low, high = (np.array([int.from_bytes(x, "little")], dtype=np.uint64) for x in (u[:8], u[8:]))
            at = int(self._slot(low, high)[0])
            while self.size[at]:
                at = (at + 1) % slots
            self.low[at], self.high[at], self.size[at] = low[0], high[0], sizes[u] + 1

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix(low ^ mix(high)) & self.mask

    def look(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Tokens of each unit, -1 where the table does not hold it."""
        found = np.full(len(low), -1, dtype=np.int64)
        open_, at = np.arange(len(low)), self._slot(low, high)
        while len(open_):
            size = self.size[at]
            hit = (size > 0) & (self.low[at] == low[open_]) & (self.high[at] == high[open_])
            found[open_[hit]] = size[hit].astype(np.int64) - 1
            on = (size > 0) & ~hit
            open_, at = open_[on], (at[on] + np.uint64(1)) & self.mask
        return found


class UnitSizes(dict):
    """Tokens of single units: the memory of a worker, filled by the tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __missing__(self, unit: bytes) -> int:
        n = len(self.tokenizer.encode(unit.decode(), add_special_tokens=False).ids)
        if len(unit) <= MEMO_BYTES:
            if len(self) >= MEMO_UNITS:
                self.clear()
            self[unit] = n
        return n


@lru_cache(maxsize=2)
def unit_sizes(path: str) -> UnitSizes:
    return UnitSizes(path)


def chunks(bodies: list[bytes], limit: int = CHUNK) -> Iterator[tuple[list[int], bytes, list[int]]]:
    """Texts joined by line ends: their numbers, the joined bytes, where each begins."""
    numbers, parts, begins, held = [], [], [], 0
    for i, body in enumerate(bodies):
        for part in pieces(body, limit):
            if held + len(part) > limit and parts:
                yield numbers, b"\n".join(parts), begins
                numbers, parts, begins, held = [], [], [], 0
            numbers.append(i)
            parts.append(part)
            begins.append(held)
            held += len(part) + 1
    if parts:
        yield numbers, b"\n".join(parts), begins


def count_tokens(bodies: list[bytes], table: LengthTable, memory: dict[bytes, int]) -> np.ndarray:
    """Tokens of each text."""
    total = np.zeros(len(bodies), dtype=np.int64)
    for numbers, raw, begins in chunks(bodies):
        start, end, b = units_of(raw)
        if not len(start):
            continue
        low, high, named = keys_of(start, end, b)
        n = np.full(len(start), -1, dtype=np.int64)
        n[named] = table.look(low[named], high[named])
        missed = np.flatnonzero(n < 0)
        folded = b.tobytes()
        n[missed] = [memory[folded[i:j]] for i, j in zip(start[missed].tolist(), end[missed].tolist())]
        owner = np.searchsorted(np.array(begins), start, side="right") - 1
        sums = np.bincount(owner, weights=n, minlength=len(numbers)).astype(np.int64)
        np.add.at(total, np.array(numbers), sums)
    return total


def _common_units(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()
    for batch in batches:
        for _, raw, _ in chunks(texts(batch.column("text"))):
            start, end, b = units_of(raw)
            folded = b.tobytes()
            short = end - start <= KEY_BYTES
            seen.update(folded[i:j] for i, j in zip(start[short].tolist(), end[short].tolist()))
            if len(seen) > 8 * limit:
                seen = Counter(dict(seen.most_common(4 * limit)))
    best = seen.most_common(limit)
    yield pa.RecordBatch.from_pydict({
        "unit": pa.array([u for u, _ in best], pa.binary()), "n": pa.array([n for _, n in best], pa.int64())})


def frequent_units(docs: DataFrame, sample: int = SAMPLE, limit: int = TABLE_UNITS) -> list[bytes]:
    """The most frequent units of a sample of about ``sample`` documents."""
    n = docs.count()
    picked = docs.select("text").sample(False, min(1.0, sample / max(n, 1)), 7).repartition(SAMPLE_PARTS)
    total: Counter[bytes] = Counter()
    for r in picked.mapInArrow(lambda batches: _common_units(batches, limit), "unit binary, n long").collect():
        total[bytes(r.unit)] += r.n
    return [u for u, _ in total.most_common(limit)]


def token_counts(
    docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT,
    sample: int = SAMPLE, table_units: int = TABLE_UNITS,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs`` (doc_id, text).

    NULL text is empty and has no tokens.  Special strings inside a text are
    what the tokenizer's file makes of them; nothing is added, cut or padded.
    Rows that repeat a doc_id are each counted; a NULL doc_id stays NULL.  Other
    columns are not read.  An empty table gives an empty result.

    ``sample`` and ``table_units`` bound the broadcast table.  They change how
    often a worker asks its own memory, never a count.
    """
    path = tokenizer or default_tokenizer()
    docs = docs.select("doc_id", "text")
    memory = UnitSizes(path)
    table = LengthTable({u: memory[u] for u in frequent_units(docs, sample, table_units)})
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unit_sizes(path)
        for batch in batches:
            bodies = texts(batch.column("text"))
            n = count_tokens(bodies, shared.value, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in bodies], pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""Schema drift inside a folder of Parquet files: every file against the declared schema.

A reader shows one schema for a folder.  Here the footers are read file by
file, on the executors; no row is read and no schema is merged on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS = "file string, column_name string, declared string, found string, status string"

_NAMES = {
    pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint",
    pa.float32(): "float", pa.float64(): "double", pa.bool_(): "boolean", pa.date32(): "date",
}
#: Whole-number types by the digits they hold, and which types hold all values of which.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_WIDER = {"float": {"double"}, "date": {"timestamp_ntz", "timestamp"}}


def type_name(t: pa.DataType) -> str:
    """Spark's name of a file's simple type."""
    if t in _NAMES:
        return _NAMES[t]
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_binary(t) or pa.types.is_large_binary(t) or pa.types.is_fixed_size_binary(t):
        return "binary"
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    if pa.types.is_timestamp(t):  # nanoseconds are the 96-bit form, which has no zone but is an instant
        return "timestamp" if t.tz or t.unit == "ns" else "timestamp_ntz"
    return str(t)


def file_leaves(fields: pa.Schema | pa.StructType, at: str = "") -> dict[str, str]:
    """Path and type of every simple column of a file."""
    out: dict[str, str] = {}

    def walk(path: str, t: pa.DataType) -> None:
        if pa.types.is_struct(t):
            for f in t:
                walk(f"{path}.{f.name}", f.type)
        elif pa.types.is_map(t):
            walk(f"{path}.key", t.key_type)
            walk(f"{path}.value", t.item_type)
        elif pa.types.is_list(t) or pa.types.is_large_list(t):
            walk(f"{path}.element", t.value_type)
        else:
            out[path] = type_name(t)

    for f in fields:
        walk(f.name, f.type)
    return out


def declared_leaves(schema: T.StructType) -> dict[str, str]:
    """The same of a declared schema."""
    out: dict[str, str] = {}

    def walk(path: str, t: T.DataType) -> None:
        if isinstance(t, T.StructType):
            for f in t:
                walk(f"{path}.{f.name}", f.dataType)
        elif isinstance(t, T.MapType):
            walk(f"{path}.key", t.keyType)
            walk(f"{path}.value", t.valueType)
        elif isinstance(t, T.ArrayType):
            walk(f"{path}.element", t.elementType)
        else:
            out[path] = t.simpleString()

    for f in schema:
        walk(f.name, f.dataType)
    return out


def _holds(wide: str, narrow: str) -> bool:
    """Whether every value of ``narrow`` fits ``wide``."""
    def digits(t: str) -> tuple[int, int] | None:  # before and behind the point
        if t in _DIGITS:
            return _DIGITS[t], 0
        if t.startswith("decimal("):
            p, s = map(int, t[8:-1].split(","))
            return p - s, s
        return None

    a, b = digits(wide), digits(narrow)
    if a and b:
        return a[0] >= b[0] and a[1] >= b[1]
    if wide == "double" and narrow in ("tinyint", "smallint", "int"):
        return True
    return wide in _WIDER.get(narrow, ())


def status(declared: str | None, found: str | None) -> str | None:
    """``missing``, ``unexpected``, ``widened``, ``narrowed`` or ``type``; None where they agree."""
    if declared == found:
        return None
    if found is None:
        return "missing"
    if declared is None:
        return "unexpected"
    if _holds(found, declared):
        return "widened"
    return "narrowed" if _holds(declared, found) else "type"


def _differences(path: str, declared: dict[str, str]) -> list[tuple]:
    try:
        store, name = fs.FileSystem.from_uri(path)
        found = file_leaves(pq.read_schema(name, filesystem=store))
    except (OSError, pa.ArrowException) as e:
        return [(path, None, None, str(e)[:200], "unreadable")]
    rows = []
    for column in [*declared, *(c for c in found if c not in declared)]:
        said = status(declared.get(column), found.get(column))
        if said:
            rows.append((path, column, declared.get(column), found.get(column), said))
    return rows


def schema_drift(spark: SparkSession, folder: str, declared: T.StructType) -> DataFrame:
    """(file, column_name, declared, found, status): one row per file and difference.

    Nested columns are compared by their simple parts (``a.b``, ``a.element``).
    Columns that the folders' names hold are not part of any file: leave them
    out of ``declared``.  A file without a readable footer gives one row,
    ``unreadable``.  Spark lists the files and deals them to tasks by size;
    tasks read footers only.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .load(folder).select("path")  # without the column of contents nothing is read
    )
    leaves = declared_leaves(declared)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        for batch in batches:
            rows = [r for p in batch.column("path").to_pylist() for r in _differences(p, leaves)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in (zip(*rows) if rows else [[]] * len(names))], names)

    return files.mapInArrow(look, ROWS)

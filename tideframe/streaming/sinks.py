"""Writers for micro-batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions.joins import broadcast_if_small
from tideframe.operators.tables import skip_existing

BatchWriter = Callable[[DataFrame, int], None]


def parquet_batches(path: str) -> BatchWriter:
    """One folder per batch, overwritten when a batch is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def jdbc_options(
    url: str, table: str, user: str, password: str,
    driver: str = "org.postgresql.Driver", partitions: int = 8,
) -> dict[str, str]:
    """Options of a relational sink; ``partitions`` bounds its connections."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "numPartitions": str(partitions),
    }


def missing_rows_batches(
    read: Callable[[SparkSession], DataFrame],
    append: Callable[[DataFrame], None],
    keys: list[str],
) -> BatchWriter:
    """Appends the rows of a batch whose key the target does not hold.

    A batch that is replayed, also after it was written in part, adds only what
    is missing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append(skip_existing(read(batch.sparkSession), batch, keys))

    return write


#: Columns a ledger sink adds to its rows, and the rows of the ledger itself.
ATTEMPT = ["stream", "batch_id", "attempt"]
LEDGER = "stream string, batch_id long, attempt string, n_rows long"


def ledger_batches(
    stream: str,
    append_rows: Callable[[DataFrame], None],
    append_mark: Callable[[DataFrame], None],
    marked: Callable[[SparkSession, str, int], DataFrame],
) -> BatchWriter:
    """Appends each batch once, without ever reading the rows already there.

    Rows are staged with stream, batch and a new attempt; then one row in the
    ledger marks the attempt.  Readers take marked attempts only
    (``marked_rows``), so a batch that stopped before its mark is as if it had
    not been, and one that is replayed after it is skipped by a look at one row
    of the ledger.  ``stream`` names the checkpoint: a stream that starts anew
    counts its batches from 0 and needs another name.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not marked(spark, stream, batch_id).isEmpty():
            return
        attempt = uuid.uuid4().hex
        named = dict(zip(ATTEMPT, (F.lit(stream), F.lit(batch_id).cast("long"), F.lit(attempt))))
        counted = Observation("written")
        rows = batch.withColumns(named).observe(counted, F.count(F.lit(1)).alias("n"))
        append_rows(rows)
        append_mark(spark.createDataFrame([(stream, batch_id, attempt, counted.get["n"])], LEDGER))

    return write


def marked_rows(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows of marked attempts; of a batch two writers marked, those of one.

    The ledger has one row per batch; it is not broadcast unmeasured.
    """
    chosen = ledger.groupBy("stream", "batch_id").agg(F.min("attempt").alias("attempt"))
    return rows.join(broadcast_if_small(chosen), ATTEMPT, "left_semi")


def _exists(spark: SparkSession, folder: str) -> bool:
    """Whether any store Spark writes to holds ``folder``; no other folder is listed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def parquet_ledger(path: str, stream: str) -> BatchWriter:
    """A ledger sink of two Parquet folders below ``path``.

    A batch's mark is a file of its own folder, so a look at it lists one folder.
    """

    def mark_folder(batch_id: int) -> str:
        return f"{path}/ledger/of={stream}/batch={batch_id}"

    def append_mark(mark: DataFrame) -> None:
        batch_id = mark.first().batch_id
        mark.coalesce(1).write.mode("append").parquet(mark_folder(batch_id))

    def marked(spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        if not _exists(spark, mark_folder(batch_id)):
            return spark.createDataFrame([], LEDGER)
        return spark.read.schema(LEDGER).parquet(mark_folder(batch_id))

    return ledger_batches(stream, lambda rows: rows.write.mode("append").parquet(f"{path}/rows"), append_mark, marked)


def read_parquet_ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows (of ``schema``) of the marked batches, with stream, batch_id and attempt."""
    full = T.StructType([*schema.fields, T.StructField("stream", T.StringType()),
                         T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.StringType())])
    rows = spark.read.schema(full).parquet(f"{path}/rows")
    ledger = spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{path}/ledger")
    return marked_rows(rows, ledger)


def jdbc_ledger(options: dict[str, str], ledger_table: str, stream: str) -> BatchWriter:
    """A ledger sink of two relational tables.

    The database looks up one row of the ledger by stream and batch; the table
    of rows is only appended to.
    """
    mark_options = {**options, "dbtable": ledger_table}

    def append(rows: DataFrame, to: dict[str, str]) -> None:
        rows.write.format("jdbc").options(**to).mode("append").save()

    def marked(spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        ledger = spark.read.format("jdbc").options(**mark_options).load()
        return ledger.filter((F.col("stream") == name) & (F.col("batch_id") == batch_id))  # pushed down

    return ledger_batches(
        stream, lambda rows: append(rows, options), lambda mark: append(mark, mark_options), marked)

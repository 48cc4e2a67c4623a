"""Writing state: snapshots, upserts and inserts that skip known keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.operators.rollup import dedupe_rows


def skip_existing(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``target`` yet, one per key.

    Of several new rows with a key the first in the order of the other columns
    is taken, as an insert that does nothing on conflict keeps one.
    """
    return dedupe_rows(new, keys, []).join(target.select(*keys), keys, "left_anti").select(*new.columns)


def keyed_upsert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``new`` inserted or replaced by key, one per key."""
    new = dedupe_rows(new, keys, [])
    kept = target.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new.select(*target.columns))


def write_snapshot(df: DataFrame, path: str, partition: str) -> None:
    """Replaces only the partitions present in ``df``; a rerun is harmless.

    Rows are rebalanced by partition value: few files for a small partition,
    several tasks for a large one.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    key: str,
    buckets: int,
    partition_by: str | None = None,
) -> DataFrame:
    """Overwrites a bucketed table and reads it back.

    The shuffle uses the hash of the bucketing, so a task holds whole buckets
    and writes one file per partition value and bucket.  Rebalancing lets AQE
    spread a bucket with a hot key over several tasks, which adds files to that
    bucket.  Choose ``buckets`` so that a bucket is about 1 GB.
    """
    spark = df.sparkSession
    writer = (
        df.hint("rebalance", buckets, F.col(key))
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def insert_snapshot(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Adds or replaces the snapshots in ``df`` in a partitioned, bucketed table.

    A step joins the snapshot before it by the key.  With the state bucketed by
    that key, and at least ``spark.sql.shuffle.partitions`` buckets, only the
    day's input is shuffled to the join, not the state.
    """
    columns = df.sparkSession.table(table).columns
    (
        df.select(*columns)
        .hint("rebalance", buckets, F.col(key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .insertInto(table)
    )


def insert_missing(
    spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition: str
) -> None:
    """Appends the rows of ``new`` whose key the table does not hold."""
    target = spark.read.schema(new.schema).parquet(path)
    skip_existing(target, new, keys).write.mode("append").partitionBy(partition).parquet(path)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: list[str],
    partition: str,
    staging: str,
) -> None:
    """Upserts into the partitions that ``new`` touches.

    A plan must not overwrite what it reads, so the merged rows are first
    written to ``staging``, a new folder on shared storage, and then replace
    the partitions dynamically.  ``new`` is computed once, one row per key,
    into the same folder.
    """
    merged, once = f"{staging}/merged", f"{staging}/new"
    dedupe_rows(new, keys, []).write.parquet(once)
    new = spark.read.schema(new.schema).parquet(once)
    target = spark.read.schema(new.schema).parquet(path)
    # dynamic partition pruning keeps the scan to the touched folders
    touched = target.join(new.select(partition).distinct(), partition, "left_semi")
    kept = touched.join(new.select(*keys), keys, "left_anti").select(*new.columns)
    write_snapshot(kept.unionByName(new), merged, partition)
    write_snapshot(spark.read.schema(new.schema).parquet(merged), path, partition)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replaces the rows of an existing catalog table; columns are matched by name."""
    df.select(*df.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)

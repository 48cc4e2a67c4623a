"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Shuffled bytes that a task reads; its sorts and hash tables need up to about 50
# times as much memory.  Of files, of which it reads some columns, it scans twice that.
TASK_BYTES = 8 * 1024 * 1024

# What the plans count on; runtime settings, see tune().
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key also where the grouping above the join would reuse
    # its partitioning; the extra shuffle is cheaper than one endless task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Up to this size small partitions become one: the default of 64 MB is
    # gigabytes of memory in a task with several windows.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
}

DEFAULTS = {
    **ADAPTIVE,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Map-side merge of session windows, so that one hot (ip, host) reaches
    # its reducer as a few pre-merged sessions per map task.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app: str = "tideframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings the operators were measured with.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` so that
    one partition is 100-200 MB of shuffle data; AQE coalesces small ones.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below ``folder``, in any store Spark reads; no file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def tune(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Turns on adaptive execution and skew splitting in a session made elsewhere.

    With the folder of the inputs, shuffles and scans are also cut by its size,
    so that what a task holds is the same for any size: shuffles into a partition
    per TASK_BYTES, of which adaptive execution makes few where there is little.
    """
    for k, v in ADAPTIVE.items():
        spark.conf.set(k, v)
    if folder is not None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(least, -(-stored_bytes(spark, folder) // TASK_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 * TASK_BYTES))
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables and stream checkpoints of one run.

    It lies under the shared folder the cluster names in
    ``spark.checkpoint.dir``; without that setting under the warehouse folder,
    which every session has and a cluster shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"

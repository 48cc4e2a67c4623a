"""Sessions of a stream, and the job that writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideframe.operators.sessions import GAP, KEYS
from tideframe.streaming.sinks import BatchWriter
from tideframe.streaming.sources import kafka_events, with_watermark

# Fixed value: time between micro-batches, and so between checkpoints.
TRIGGER = "10 seconds"

STATE_STORE = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session for streams of session windows.

    Windows are merged before the shuffle: events of a hot (ip, host) leave a
    task as merged sessions, so what its one reducer sees is bounded by time and
    tasks, not by the number of events.  State is kept in RocksDB, off the heap.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    return own


def session_windows(
    events: DataFrame, ts: str = "window_timestamp", gap: str = GAP
) -> DataFrame:
    """Closed sessions, once the watermark has passed their end."""
    w = F.session_window(ts, gap).alias("w")
    return (
        events.groupBy(w, *KEYS)
        .agg(F.count("host").alias("num_hits"))
        .select(
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            *KEYS,
            "num_hits",
        )
    )


#: The stateful operator that keeps open windows, as a checkpoint names it.
WINDOW_STATE = "sessionWindowStateStoreSaveExec"


def committed(spark: SparkSession, checkpoint: str) -> tuple[int, int]:
    """The last micro-batch with stored windows, and the number of their operator."""
    operators = spark.read.format("state-metadata").load(checkpoint)
    found = operators.filter(F.col("operatorName") == WINDOW_STATE).first()
    if found is None:
        raise ValueError(f"no session windows in the checkpoint {checkpoint}")
    return found.maxBatchId, found.operatorId


def open_sessions(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Sessions the stream has not closed yet, in the columns of ``session_windows``.

    They are read from the state store, as micro-batch ``batch`` left it (the
    last by default).  A batch either closes a session or keeps it, so the rows
    written by batches up to ``batch`` and these have none in common, and
    together they are the sessions of all events so far.
    """
    last, operator = committed(spark, checkpoint)
    state = (
        spark.read.format("statestore")
        .option("operatorId", operator)
        .option("batchId", last if batch is None else batch)
        .load(checkpoint)
    )
    hits = state.schema["value"].dataType.names[-1]  # the count follows window and keys
    window = F.col("value.session_window")
    return state.select(
        window["start"].alias("session_start"), window["end"].alias("session_end"),
        *[F.col(f"key.{k}") for k in KEYS], F.col(f"value.{hits}").alias("num_hits"),
    )


def start_to_files(
    sessions: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Appends closed sessions to Parquet files, exactly once."""
    writer = (
        sessions.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    writer = (
        writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    )
    return writer.start()


def start_to_batches(
    sessions: DataFrame, write: BatchWriter, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Hands each micro-batch of closed sessions to ``write``."""
    writer = (
        sessions.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = (
        writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    )
    return writer.start()


def start_web_sessions(
    spark: SparkSession,
    kafka: dict[str, str],
    write: BatchWriter,
    checkpoint: str,
) -> StreamingQuery:
    """The whole job: topic to sessions to ``write``, one batch per trigger."""
    events = kafka_events(streaming_session(spark), kafka)
    return start_to_batches(session_windows(with_watermark(events)), write, checkpoint)


def run(query: StreamingQuery) -> None:
    """Waits for the end; an error of the stream is raised here, not logged."""
    query.awaitTermination()

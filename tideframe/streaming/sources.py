"""Streams of web events, from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.schemas import WEB_TRAFFIC

# Text form of event times, and how late an event may be.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
LATENESS = "15 seconds"


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    key: str | None = None,
    secret: str | None = None,
    starting: str = "latest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a JSON topic; SASL over TLS when a key is given.

    ``max_offsets`` bounds the messages of one micro-batch, so that a backlog
    is worked off in batches of equal size.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if group:
        options["kafka.group.id"] = group
    if key:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                "org.apache.kafka.common.security.plain.PlainLoginModule required "
                f'username="{key}" password="{secret or ""}";'
            ),
        }
    return options


def kafka_events(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Parsed events of a topic.  Needs Spark's Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return parse_web_traffic(raw.select(F.col("value").cast("string").alias("value")))


def parse_event_time(text: Column) -> Column:
    """Text to a timestamp in the session's zone (UTC); malformed text to NULL."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN))


def parse_web_traffic(messages: DataFrame) -> DataFrame:
    """JSON text in ``value`` to the declared fields and the event time."""
    event = F.from_json("value", WEB_TRAFFIC)
    return messages.select(event.alias("e")).select(
        "e.*", parse_event_time(F.col("e.event_time")).alias("window_timestamp")
    )


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream.

    ``glob`` names entries of the folder, which may be files or folders of part
    files; ``bytes_per_trigger`` bounds a micro-batch while a backlog is read.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        folder = f"{folder}/{{{glob}}}"
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(folder)


def with_watermark(
    events: DataFrame, ts: str = "window_timestamp", lateness: str = LATENESS
) -> DataFrame:
    """Event time bounded by a delay; a zone-less time is read as UTC."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def drop_redelivered(events: DataFrame, keys: list[str]) -> DataFrame:
    """Watermarked events without those an at-least-once topic delivered again.

    A redelivered event has the ``keys`` and the time of the first one.  A key is
    kept as state until the watermark has passed its time and the lateness; a
    copy that comes later still is behind the watermark and dropped with all
    late rows.  So the state is bounded by time, and no copy gets through.
    NULLs in ``keys`` count as values.
    """
    return events.dropDuplicatesWithinWatermark(keys)

"""Streams over files: closed sessions, late events, parsing, sinks."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import rows
from tideframe.operators.sessions import session_hits
from tideframe.streaming import sessions as SS
from tideframe.streaming import sinks as SI
from tideframe.streaming import sources as SO

T0 = datetime(2024, 1, 1)


def message(ip, host, t):
    text = t if isinstance(t, str) else t.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return json.dumps(
        {"ip": ip, "event_time": text, "referrer": "r", "host": host, "url": "/", "geodata": "{}"}
    )


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def add_files(folder, batches, first=0):
    source = folder / "in"
    source.mkdir(exist_ok=True)
    for i, b in enumerate(batches, first):
        f = source / f"{i}.json"
        f.write_text("\n".join(message(*m) for m in b))
        os.utime(f, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def start(spark, folder):
    """Files are read one per micro-batch, oldest first."""
    own = SS.streaming_session(spark)
    raw = SO.file_stream(own, str(folder / "in"), SO.WEB_TRAFFIC, "json", files_per_trigger=1)
    events = raw.withColumn("window_timestamp", SO.parse_event_time(F.col("event_time")))
    sessions = SS.session_windows(SO.with_watermark(events))
    query = SS.start_to_files(sessions, str(folder / "out"), str(folder / "cp"), once=True)
    SS.run(query)
    return query, own.read.schema(sessions.schema).parquet(str(folder / "out"))


def run(spark, folder, batches):
    add_files(folder, batches)
    return start(spark, folder)[1]


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    first = [[("a", "h", at(0))], [("a", "h", at(100)), ("b", "h", at(150))]]
    then = [[("a", "h", at(300))], [("z", "h", at(9000))]]
    add_files(tmp_path, first)
    assert start(spark, tmp_path)[1].count() == 0  # nothing is closed yet
    add_files(tmp_path, then, first=2)
    assert rows(start(spark, tmp_path)[1], "ip", "num_hits") == [("a", 3), ("b", 1)]
    # a third start without new files repeats nothing
    assert rows(start(spark, tmp_path)[1], "ip", "num_hits") == [("a", 3), ("b", 1)]


def test_hot_keys_are_merged_before_the_shuffle(spark, tmp_path, capsys):
    add_files(tmp_path, [[("a", "h", at(i)) for i in range(50)], [("z", "h", at(9000))]])
    query, out = start(spark, tmp_path)
    query.explain()
    p = capsys.readouterr().out
    assert p.count("MergingSessions") == 2
    assert p.rindex("MergingSessions") > p.index("Exchange hashpartitioning")
    assert rows(out, "ip", "num_hits") == [("a", 50)]


def test_closed_sessions_equal_the_batch(spark, tmp_path):
    batches = [
        [("a", "h", at(0)), ("a", "h", at(200)), ("b", "h", at(10))],
        [("a", "h", at(500)), ("b", "h", at(400))],
        [("a", "h", at(2000)), ("c", "h", at(2500))],
        [("d", "h", at(9000))],
    ]
    out = run(spark, tmp_path, batches)
    flat = [(ip, h, t) for b in batches for ip, h, t in b]
    batch = session_hits(spark.createDataFrame(flat, "ip string, host string, event_time timestamp"))
    closed = batch.filter(F.col("session_end") <= F.lit(at(9000 - 15)))
    assert rows(out) == rows(closed)
    assert batch.count() - closed.count() == 1  # the last one is still open


def test_late_event_does_not_reopen_a_closed_session(spark, tmp_path):
    out = run(
        spark, tmp_path,
        [[("a", "h", at(0))], [("b", "h", at(5000))], [("b", "h", at(5100))],
         [("a", "h", at(100))], [("z", "h", at(20000))]],
    )
    assert rows(out, "ip", "session_start", "num_hits") == [
        ("a", at(0), 1), ("b", at(5000), 2)
    ]


def test_malformed_time_is_skipped_and_null_host_counts_nothing(spark, tmp_path):
    out = run(
        spark, tmp_path,
        [[("a", "h", "yesterday"), ("a", None, at(0)), ("a", None, at(1))], [("z", "h", at(9000))]],
    )
    assert rows(out, "ip", "host", "num_hits") == [("a", None, 0)]


def test_error_of_a_stream_is_raised(spark, tmp_path):
    add_files(tmp_path, [[("a", "h", at(0))]])
    own = SS.streaming_session(spark)
    raw = SO.file_stream(own, str(tmp_path / "in"), SO.WEB_TRAFFIC, "json")
    broken = raw.select(F.raise_error(F.lit("broken row")).cast("string").alias("x"))
    query = SS.start_to_files(broken, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    with pytest.raises(StreamingQueryException, match="broken row"):
        SS.run(query)


def test_messages_are_parsed(spark):
    df = spark.createDataFrame(
        [(message("1", "h", "2024-01-02T03:04:05.678Z"),), ("no json",)], "value string"
    )
    got = SO.parse_web_traffic(df).select("ip", "host", "url", "window_timestamp").collect()
    assert tuple(got[0]) == ("1", "h", "/", datetime(2024, 1, 2, 3, 4, 5, 678000))
    assert tuple(got[1]) == (None, None, None, None)


def test_replayed_batch_is_written_once(spark, tmp_path):
    write = SI.parquet_batches(str(tmp_path / "sink"))
    df = spark.createDataFrame([(1,), (2,)], "x int")
    write(df, 0)
    write(df, 0)
    write(df.filter("x = 1"), 1)
    assert rows(spark.read.parquet(str(tmp_path / "sink")), "batch_id", "x") == [
        (0, 1), (0, 2), (1, 1)
    ]


def test_connector_options():
    o = SO.kafka_options("host:9092", "topic", "group", "user", "pass")
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["startingOffsets"] == "latest"
    assert 'username="user" password="pass"' in o["kafka.sasl.jaas.config"]
    assert "kafka.security.protocol" not in SO.kafka_options("host:9092", "topic")
    j = SI.jdbc_options("jdbc:postgresql://h/db", "sessions", "u", "p")
    assert j["dbtable"] == "sessions" and j["driver"] == "org.postgresql.Driver"


def test_batches_from_a_folder_of_part_files(spark, tmp_path):
    """A table stored as several files is read whole, and each batch is handed on."""
    data = [(ip, "h", at(s)) for ip in "abc" for s in range(0, 4000, 130)] + [("z", "h", at(99_000))]
    df = spark.createDataFrame(data, "ip string, host string, window_timestamp timestamp")
    df.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    df.limit(1).write.parquet(str(tmp_path / "other.parquet"))
    own = SS.streaming_session(spark)
    raw = SO.file_stream(own, str(tmp_path), df.schema, glob="events.parquet")
    sessions = SS.session_windows(SO.with_watermark(raw))
    SS.run(SS.start_to_batches(sessions, SI.parquet_batches(str(tmp_path / "out")), str(tmp_path / "cp"), once=True))
    out = own.read.parquet(str(tmp_path / "out")).select(*sessions.columns)
    batch = session_hits(df.withColumnRenamed("window_timestamp", "event_time"))
    assert rows(out) == rows(batch.filter(F.col("session_end") <= F.lit(at(99_000 - 15))))
    assert batch.count() == out.count() + 1

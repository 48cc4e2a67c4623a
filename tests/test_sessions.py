"""Batch sessions against brute force; the exact gap; NULL hosts."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tideframe.operators import sessions as W

T0 = datetime(2024, 1, 1)
GAP = timedelta(minutes=5)
SCHEMA = "ip string, host string, event_time timestamp_ntz"


def brute(data):
    out = []
    for key in {(ip, h) for ip, h, t in data}:
        times = sorted(t for ip, h, t in data if (ip, h) == key and t is not None)
        start = last = None
        n = 0
        for t in times:
            if last is None or t > last + GAP:
                if last is not None:
                    out.append((start, last + GAP, *key, n))
                start, n = t, 0
            n += key[1] is not None
            last = t
        if last is not None:
            out.append((start, last + GAP, *key, n))
    return sorted(out, key=lambda r: (str(r[2]), str(r[3]), r[0]))


def test_gap_of_exactly_five_minutes_continues(spark):
    at = [0, 300, 600, 900.000001]
    df = spark.createDataFrame([("a", "h", T0 + timedelta(seconds=s)) for s in at], SCHEMA)
    assert rows(W.session_hits(df), "session_start", "num_hits") == [
        (T0, 3), (T0 + timedelta(seconds=900.000001), 1)
    ]


def test_random_events_with_a_hot_key(spark):
    rnd = random.Random(5)
    data = []
    for _ in range(3000):
        ip = "hot" if rnd.random() < 0.4 else f"ip{rnd.randrange(30)}"
        host = rnd.choice(["h1", "h1", "h2", None])
        data.append((ip, host, T0 + timedelta(seconds=rnd.randrange(86400), microseconds=rnd.randrange(10**6))))
    data.append(("x", "h1", None))
    got = [tuple(r) for r in W.session_hits(spark.createDataFrame(data, SCHEMA)).collect()]
    assert sorted(got, key=lambda r: (str(r[2]), str(r[3]), r[0])) == brute(data)


def test_equals_the_built_in_session_window(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).cast("string").alias("ip"), F.lit("h").alias("host"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(200_000))).alias("event_time"),
    )
    w = F.session_window("event_time", "5 minutes").alias("w")
    built_in = df.groupBy(w, "ip", "host").agg(F.count("host").alias("num_hits")).select(
        "w.start", "w.end", "ip", "host", "num_hits"
    )
    assert rows(W.session_hits(df)) == rows(built_in)


def test_hits_per_session(spark):
    s = spark.createDataFrame(
        [("h", 3), ("h", 2), ("g", 4)], "host string, num_hits long"
    )
    assert rows(W.hits_per_session(s)) == [("g", 4.0), ("h", 2.5)]
    hits = spark.createDataFrame(
        [("h", "s1"), ("h", "s1"), ("h", "s2"), ("h", None), ("none", None)],
        "host string, session_id string",
    )
    assert rows(W.hits_per_session_id(hits)) == [("h", 2.0), ("none", None)]


def test_events_carry_their_session(spark):
    df = spark.createDataFrame(
        [("a", "h", T0), ("a", "h", T0 + GAP), ("a", "h", T0 + 3 * GAP), ("a", None, T0)], SCHEMA
    )
    got = W.with_session_id(df).select("event_time", "host", "session_id.session_start")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(T0, "h", T0), (T0 + GAP, "h", T0), (T0 + 3 * GAP, "h", T0 + 3 * GAP), (T0, None, T0)],
        key=str,
    )

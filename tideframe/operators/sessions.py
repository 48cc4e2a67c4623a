"""Event-time sessions per (ip, host), batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideframe.functions.joins import null_safe

# Fixed value: a session closes after this silence.
GAP = "5 minutes"

KEYS = ["ip", "host"]


def _slots(events: DataFrame, gap: str, ts: str) -> DataFrame:
    """One row per key and slot of length ``gap``, with the session it is in.

    Events within a slot always share a session, so they are aggregated first,
    with map-side combine.  The window then sees at most one row per key and
    slot: bounded by the calendar for the hottest key.
    """
    slots = (
        events.filter(F.col(ts).isNotNull())
        .groupBy(*KEYS, F.window(ts, gap)["start"].alias("slot"))
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.count("host").alias("hits"),
        )
    )
    w = Window.partitionBy(*KEYS).orderBy("first_ts")
    before = F.lag("last_ts").over(w)
    opens = before.isNull() | (F.col("first_ts") > before + F.expr(f"interval {gap}"))
    return slots.withColumn("opened", F.when(opens, F.col("first_ts"))).withColumn(
        "session_start", F.max("opened").over(w)
    )


def session_hits(events: DataFrame, gap: str = GAP, ts: str = "event_time") -> DataFrame:
    """(session_start, session_end, ip, host, num_hits).

    A new session starts when the silence is longer than ``gap``;
    ``session_end`` is the last event plus the gap; ``num_hits`` counts
    non-NULL hosts.
    """
    return (
        _slots(events, gap, ts)
        .groupBy(*KEYS, "session_start")
        .agg(
            (F.max("last_ts") + F.expr(f"interval {gap}")).alias("session_end"),
            F.sum("hits").alias("num_hits"),
        )
        .select("session_start", "session_end", *KEYS, "num_hits")
    )


def with_session_id(events: DataFrame, gap: str = GAP, ts: str = "event_time") -> DataFrame:
    """Events with the id of their session: its key and start.

    Events meet their slot by key and slot, which spreads a hot key over time.
    """
    keys = [*KEYS, "slot"]
    started = _slots(events, gap, ts).select(
        *[F.col(k).alias(f"of_{k}") for k in keys], "session_start"
    )
    placed = events.filter(F.col(ts).isNotNull()).withColumn(
        "slot", F.window(ts, gap)["start"]
    )
    return placed.join(started, null_safe({k: f"of_{k}" for k in keys})).select(
        *events.columns, F.struct(*KEYS, "session_start").alias("session_id")
    )


def hits_per_session(sessions: DataFrame) -> DataFrame:
    """Average hits per session and host, from sessions (one row each)."""
    return sessions.groupBy("host").agg(
        (F.sum("num_hits") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias(
            "avg_hits_per_session"
        )
    )


def hits_per_session_id(hits: DataFrame) -> DataFrame:
    """The same from single hits that carry a session id.

    NULL ids are hits without a session; a host with none of them gives NULL.
    """
    per_session = hits.groupBy("host", "session_id").agg(F.count(F.lit(1)).alias("n"))
    sessions = F.count("session_id")
    return per_session.groupBy("host").agg(
        (F.sum("n") / F.nullif(sessions, F.lit(0))).alias("avg_hits_per_session")
    )

"""Sessions of a stream with its late rows beside them.

The built-in session window drops rows behind the watermark without a trace.
This processor keeps the open sessions of a key as state, closes them by
event-time timers, and hands on what came too late, so that every row is
accounted for.  A key's rows of one micro-batch pass one task, row by row: for
keys that hold much of the stream use ``sessions.session_windows``.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideframe.operators.sessions import KEYS

GAP = timedelta(minutes=5)
SESSION, LATE, OPEN = "session", "late", "open"
_MICRO = timedelta(microseconds=1)


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, hits) with those that touch or overlap made one."""
    out: list[tuple[int, int, int]] = []
    for start, end, hits in sorted(spans):
        if out and start <= out[-1][1]:
            first, last, n = out[-1]
            out[-1] = first, max(last, end), n + hits
        else:
            out.append((start, end, hits))
    return out


class SessionsAndLate(StatefulProcessor):
    """State: the open sessions of a key.  Timer: the earliest end, in whole milliseconds, rounded up.

    A key has one timer however many sessions it has open, and a micro-batch
    reads and writes its state once: each call costs a round trip to the JVM.
    """

    #: Spans gathered before they are merged, which bounds what a key holds in memory.
    GATHERED = 10_000

    def __init__(self, gap: timedelta):
        self.gap = gap // _MICRO

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "spans array<struct<start:bigint,stop:bigint,hits:bigint>>")

    def _stored(self) -> list[tuple[int, int, int]]:
        found = self.open.get()
        return [tuple(x) for x in found[0]] if found else []

    @staticmethod
    def _due(end: int) -> int:
        return -(-end // 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        before = self._stored()
        spans = list(before)
        for r in rows:
            if r.at + self.gap <= watermark:
                yield Row(kind=LATE, start=None, stop=None, ip=key[0], host=key[1], num_hits=None, at=r.at)
                continue
            spans.append((r.at, r.at + self.gap, int(r.host is not None)))
            if len(spans) > self.GATHERED:
                spans = merged(spans)
        spans = merged(spans)
        if spans != before:
            # spans do not overlap, so the first to start is the first to end
            due, old = (self._due(x[0][1]) if x else None for x in (spans, before))
            if due != old:
                if old is not None:
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(due)
            self.open.update((spans,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # timers before the watermark are due: all sessions that end there are closed by one
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        spans = self._stored()
        rest = [s for s in spans if self._due(s[1]) > now]
        for start, stop, hits in spans:
            if self._due(stop) <= now:
                yield Row(kind=SESSION, start=start, stop=stop, ip=key[0], host=key[1], num_hits=hits, at=None)
        if rest:
            self.open.update((rest,))
            self.handle.registerTimer(self._due(rest[0][1]))
        else:
            self.open.clear()

    def close(self) -> None:
        pass


def sessions_and_late(events: DataFrame, ts: str = "window_timestamp", gap: timedelta = GAP) -> DataFrame:
    """(kind, session_start, session_end, ip, host, num_hits, event_time) from watermarked events.

    ``kind`` is ``session`` for a closed session and ``late`` for a row whose
    own session would have ended behind the watermark its micro-batch began
    with.  Rows without a time are in neither.
    """
    # a plain number, which is not filtered by the watermark before the processor sees it
    rows = events.filter(F.col(ts).isNotNull()).select(*KEYS, F.unix_micros(ts).alias("at"))
    types = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("stop", T.LongType()), *[T.StructField(k, types[k]) for k in KEYS],
        T.StructField("num_hits", T.LongType()), T.StructField("at", T.LongType()),
    ])
    found = rows.groupBy(*KEYS).transformWithState(SessionsAndLate(gap), schema, "append", "EventTime")
    time = {n: F.timestamp_micros(c).alias(n) for n, c in
            (("session_start", "start"), ("session_end", "stop"), ("event_time", "at"))}
    return found.select(
        "kind", time["session_start"], time["session_end"], *KEYS, "num_hits", time["event_time"])


def open_spans(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions still open after the last finished micro-batch, in the same columns, kind ``open``."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    rows = state.select(*[F.col(f"key.{k}") for k in KEYS], F.explode("value.spans").alias("span"))
    return rows.select(
        F.lit(OPEN).alias("kind"), F.timestamp_micros("span.start").alias("session_start"),
        F.timestamp_micros("span.stop").alias("session_end"), *KEYS, F.col("span.hits").alias("num_hits"),
        F.lit(None).cast("timestamp").alias("event_time"))

"""What a stream still holds, what came twice, what came late, and batches behind a ledger."""

from __future__ import annotations

from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming import add_files, at
from tideframe.operators.sessions import session_hits
from tideframe.streaming import late as SL
from tideframe.streaming import sessions as SS
from tideframe.streaming import sinks as SI
from tideframe.streaming import sources as SO

COLUMNS = ["session_start", "session_end", "ip", "host", "num_hits"]


def hits(own, folder, files=1):
    raw = SO.file_stream(own, str(folder / "in"), SO.WEB_TRAFFIC, "json", files_per_trigger=files)
    return SO.with_watermark(raw.withColumn("window_timestamp", SO.parse_event_time(F.col("event_time"))))


def batch_form(spark, batches):
    flat = [m for b in batches for m in b]
    return session_hits(spark.createDataFrame(flat, "ip string, host string, event_time timestamp"))


def run(folder, df):
    SS.run(SS.start_to_files(df, str(folder / "out"), str(folder / "cp"), once=True))
    return df.sparkSession.read.schema(df.schema).parquet(str(folder / "out"))


# --- open sessions -----------------------------------------------------------


BATCHES = [
    [("a", "h", at(0)), ("b", "h", at(10)), ("b", None, at(20))],
    [("a", "h", at(250)), ("c", "h", at(600))],
    [("a", "h", at(2000)), ("c", "h", at(2100)), ("d", "h", at(2200))],
]


@pytest.mark.parametrize("dedup", [False, True])
def test_closed_and_open_are_all_sessions(spark, tmp_path, dedup):
    """After every micro-batch and restart; also with another stateful operator in the stream."""
    own = SS.streaming_session(spark)
    for i in range(len(BATCHES)):
        add_files(tmp_path, BATCHES[i:i + 1], first=i)
        events = hits(own, tmp_path)
        if dedup:
            events = SO.drop_redelivered(events, ["ip", "host", "event_time"])
        closed = run(tmp_path, SS.session_windows(events))
        now = SS.open_sessions(own, str(tmp_path / "cp"))
        assert now.columns == closed.columns == COLUMNS
        assert rows(closed.unionByName(now)) == rows(batch_form(spark, BATCHES[: i + 1]))
        assert now.count() > 0
    assert closed.count() > 0


def test_open_sessions_of_an_earlier_batch(spark, tmp_path):
    own = SS.streaming_session(spark)
    add_files(tmp_path, BATCHES)
    run(tmp_path, SS.session_windows(hits(own, tmp_path)))
    first = SS.open_sessions(own, str(tmp_path / "cp"), 0)
    assert rows(first) == rows(batch_form(spark, BATCHES[:1]))


def test_a_checkpoint_without_windows_is_refused(spark, tmp_path):
    own = SS.streaming_session(spark)
    add_files(tmp_path, BATCHES)
    run(tmp_path, SO.drop_redelivered(hits(own, tmp_path), ["ip"]))
    with pytest.raises(ValueError, match="no session windows"):
        SS.open_sessions(own, str(tmp_path / "cp"))


# --- redelivered events ----------------------------------------------------------


def test_events_delivered_again_count_once(spark, tmp_path):
    """In the same file, in a later one, after a restart, and behind the watermark."""
    own = SS.streaming_session(spark)
    first, second = BATCHES[0] + BATCHES[0][:1], BATCHES[1] + BATCHES[0]
    end = [("z", "h", at(9000))]

    def sessions():
        return SS.session_windows(SO.drop_redelivered(hits(own, tmp_path), ["ip", "host", "event_time"]))

    add_files(tmp_path, [first, second])
    run(tmp_path, sessions())
    add_files(tmp_path, [BATCHES[1] + BATCHES[2], end, BATCHES[0] + BATCHES[2]], first=2)
    got = run(tmp_path, sessions())
    want = batch_form(spark, [*BATCHES, end]).filter(F.col("session_end") <= F.lit(at(9000 - 15)))
    assert rows(got) == rows(want)


def test_state_of_delivered_keys_is_given_up(spark, tmp_path):
    own = SS.streaming_session(spark)
    add_files(tmp_path, [[("a", "h", at(i)) for i in range(50)], [("z", "h", at(9000))]])
    run(tmp_path, SO.drop_redelivered(hits(own, tmp_path), ["ip", "event_time"]))
    assert own.read.format("statestore").load(str(tmp_path / "cp")).count() == 1


# --- late rows ---------------------------------------------------------------------


def test_spans_merge_like_sessions():
    assert SL.merged([(5, 9, 1), (0, 5, 1), (20, 25, 1), (6, 7, 1), (26, 30, 2)]) == [(0, 9, 3), (20, 25, 1), (26, 30, 2)]
    assert SL.merged([]) == []


def test_sessions_late_and_open_account_for_every_event(spark, tmp_path):
    own = SS.streaming_session(spark)
    batches = [
        [("a", "h", at(0)), ("a", "h", at(200)), ("b", None, at(10)), ("b", "h", "no time")],
        [("c", "h", at(5000))],
        [("a", "h", at(100)), ("c", "h", at(5100)), ("c", "h", at(4990))],  # the first is late
        [("c", "h", at(9000)), ("b", "h", at(30))],  # the second is late
    ]
    out = None
    for i in range(4):  # every batch after a restart
        add_files(tmp_path, batches[i:i + 1], first=i)
        out = run(tmp_path, SL.sessions_and_late(hits(own, tmp_path)))
    late = out.filter(F.col("kind") == SL.LATE)
    assert rows(late, "ip", "host", "event_time") == [("a", "h", at(100)), ("b", "h", at(30))]
    left = SL.open_spans(own, str(tmp_path / "cp"))
    assert left.columns == out.columns
    kept = [[m for m in b if m[2] != "no time" and m not in (("a", "h", at(100)), ("b", "h", at(30)))] for b in batches]
    got = out.filter(F.col("kind") == SL.SESSION).unionByName(left)
    assert rows(got, *COLUMNS) == rows(batch_form(spark, kept), *COLUMNS)
    assert rows(left, "ip", "num_hits") == [("c", 1)]


def test_a_busy_key_is_merged_as_it_is_read(spark, tmp_path, monkeypatch):
    own = SS.streaming_session(spark)
    add_files(tmp_path, [[("a", "h", at(i)) for i in range(300)], [("z", "h", at(9000))]])
    monkeypatch.setattr(SL.SessionsAndLate, "GATHERED", 7)
    out = run(tmp_path, SL.sessions_and_late(hits(own, tmp_path)))
    assert rows(out, "kind", "ip", "num_hits") == [("session", "a", 300)]


class OneKey:
    """The state and the timers of one key, as a processor calls them."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


def test_a_key_has_one_timer_for_all_its_sessions():
    key, sessions = OneKey(), SL.SessionsAndLate(timedelta(seconds=10))
    sessions.init(key)
    second = 1_000_000

    def read(watermark, *seconds):
        rows = [Row(at=s * second, host="h") for s in seconds]
        return list(sessions.handleInputRows(("a", "h"), iter(rows), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark * 1000)))

    def expire(watermark):
        out = []
        for t in sorted(t for t in key.timers if t < watermark * 1000):
            key.timers.remove(t)
            times = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark * 1000)
            out += sessions.handleExpiredTimer(("a", "h"), times, SimpleNamespace(getExpiryTimeInMs=lambda: t))
        return [(r.start // second, r.stop // second, r.num_hits) for r in out]

    assert read(0, *range(0, 1000, 100)) == []
    assert key.timers == {10_000} and key.calls == 1
    # a session that ends at the watermark stays open; the others are closed by one call
    assert expire(510) == [(s, s + 10, 1) for s in range(0, 500, 100)]
    assert key.timers == {510_000}
    assert [r.at // second for r in read(510, 500, 505, 450)] == [500, 450]
    assert key.timers == {515_000}  # the session of 500 lasts longer now
    assert expire(2000) == [(500, 515, 2), *[(s, s + 10, 1) for s in range(600, 1000, 100)]]
    assert key.timers == set() and key.value is None


# --- the ledger ----------------------------------------------------------------------


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def ledger(spark, path):
    df = frame(spark)
    return rows(SI.read_parquet_ledger(spark, path, df.schema), "batch_id", "x")


def test_batch_replayed_after_its_mark_is_skipped(spark, tmp_path):
    path = str(tmp_path / "sink")
    write = SI.parquet_ledger(path, "s")
    write(frame(spark, 1, 2), 0)
    write(frame(spark, 1, 2), 0)
    write(frame(spark), 1)
    write(frame(spark, 1), 2)
    assert ledger(spark, path) == [(0, 1), (0, 2), (2, 1)]
    assert spark.read.parquet(f"{path}/rows").count() == 3  # nothing was staged again
    assert rows(spark.read.option("recursiveFileLookup", True).parquet(f"{path}/ledger"), "batch_id", "n_rows") == [
        (0, 2), (1, 0), (2, 1)]


def test_batch_that_failed_before_its_mark_is_not_there(spark, tmp_path):
    path = str(tmp_path / "sink")
    whole = SI.parquet_ledger(path, "s")
    whole(frame(spark, 7), 0)

    def fails(mark):
        raise RuntimeError("lost")

    broken = SI.ledger_batches(
        "s", lambda df: df.write.mode("append").parquet(f"{path}/rows"), fails, lambda *_: frame(spark))
    for _ in range(2):
        with pytest.raises(RuntimeError):
            broken(frame(spark, 1, 2), 1)
    assert ledger(spark, path) == [(0, 7)]
    whole(frame(spark, 1, 2), 1)
    assert ledger(spark, path) == [(0, 7), (1, 1), (1, 2)]
    assert spark.read.parquet(f"{path}/rows").count() == 7  # two attempts stay unseen


def test_of_two_marks_one_counts(spark):
    staged = spark.createDataFrame([(1, "s", 0, "a"), (1, "s", 0, "b"), (2, "t", 0, "a")],
                                   "x int, stream string, batch_id long, attempt string")
    marks = spark.createDataFrame([("s", 0, "b", 1), ("s", 0, "a", 1), ("t", 0, "a", 1)], SI.LEDGER)
    assert rows(SI.marked_rows(staged, marks), "x", "stream", "attempt") == [(1, "s", "a"), (2, "t", "a")]


def test_streams_have_their_own_batches(spark, tmp_path):
    path = str(tmp_path / "sink")
    for name in ("s", "t"):
        SI.parquet_ledger(path, name)(frame(spark, 1), 0)
    assert ledger(spark, path) == [(0, 1), (0, 1)]


def test_the_rows_are_never_read(spark, tmp_path):
    """A look at the ledger is all a batch asks of its target."""
    asked, appended = [], []

    def marked(s, name, batch_id):
        asked.append((name, batch_id))
        return frame(s)

    write = SI.ledger_batches("s", lambda df: appended.append(df.count()), lambda m: appended.append(m.collect()), marked)
    write(frame(spark, 1, 2, 3), 5)
    assert asked == [("s", 5)] and appended[0] == 3
    assert [tuple(r)[:2] + (r.n_rows,) for r in appended[1]] == [("s", 5, 3)]

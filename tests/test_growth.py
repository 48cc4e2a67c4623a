"""Growth states by day and by year."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tideframe.operators import experiments as E
from tideframe.operators import growth as G
from tideframe.schemas import PLAYERS

D0 = date(2023, 3, 1)


def activity(spark, *items):
    return spark.createDataFrame(
        [(n, D0 + timedelta(days=d), 2020) for n, d in items],
        "player_name string, effective_date date, current_season int",
    )


def states(df, name):
    return [(r[0] - D0).days for r in rows(df, "date")] and [
        (r[1], r[2]) for r in rows(df.filter(f"player_name = '{name}'"), "date",
                                   "daily_active_state", "yearly_active_state")
    ]


def test_daily_states(spark):
    df = activity(spark, ("a", 0), ("a", 1), ("a", 4), ("end", 5))
    out = G.growth_backfill(df)
    assert [d for d, _ in states(out, "a")] == [
        "New", "Continued Playing", "Retired", "Stayed Retired",
        "Returned from retirement", "Retired",
    ]
    assert states(out, "end") == [("New", "New")]


def test_yearly_return_needs_more_than_a_year(spark):
    for gap, state in [(365, "Continued Playing"), (366, "Returned from retirement")]:
        out = G.growth_backfill(activity(spark, ("a", 0), ("a", gap)))
        last = rows(out, "date", "yearly_active_state")[-1]
        assert last == (D0 + timedelta(days=gap), state)


def test_steps_equal_backfill(spark):
    df = activity(spark, ("a", 0), ("a", 1), ("a", 1), ("b", 1), ("a", 4), ("c", 3), ("b", 4))
    state = spark.createDataFrame([], PLAYERS)
    got = []
    for i in range(5):
        step = G.growth_step(state, df, D0 + timedelta(days=i)).collect()
        got += step
        state = spark.createDataFrame(
            [[r[c] for c in PLAYERS.fieldNames()] for r in step], PLAYERS
        )
    want = G.growth_backfill(df)
    assert rows(spark.createDataFrame(got, want.schema)) == rows(want)


def test_latest_activity(spark):
    df = activity(spark, ("a", 0), ("a", 3), ("b", 1))
    assert rows(G.latest_activity(df, 2020)) == [
        ("a", 2020, D0 + timedelta(days=3)), ("b", 2020, D0 + timedelta(days=1))
    ]
    assert G.latest_activity(df, 2019).count() == 0


def test_growth_counts(spark):
    s = G.growth_counts(activity(spark, ("a", 0), ("a", 2), ("b", 0)))
    assert rows(E.growth_total(s)) == [
        (D0, 2, 2, 0, 0, 2),
        (D0 + timedelta(days=1), 0, 0, 0, 2, -2),
        (D0 + timedelta(days=2), 1, 0, 1, 0, 1),
    ]
    assert (D0, "New", 2) in rows(s)


@pytest.mark.parametrize("state", ["daily_active_state", "yearly_active_state"])
def test_counts_and_snapshots_equal_the_grid(spark, state):
    r = random.Random(3)
    items = [(f"p{i % 9}", r.randrange(900) if i % 4 else i % 9) for i in range(60)]
    df = activity(spark, *items)
    grid = G.growth_backfill(df)
    counts = grid.groupBy("date", state).count()
    assert rows(G.growth_counts(df, state)) == rows(counts)
    explodes = plan(G.growth_counts(df, state)).split("Exchange")
    assert "sequence" not in explodes[-1] and "sequence" in explodes[0]  # after the last shuffle
    for d in (0, 450, 899):
        day = D0 + timedelta(days=d)
        assert rows(G.growth_snapshot(df, day)) == rows(G.growth_backfill(df, day).filter(F.col("date") == day))


def test_skipped_day_is_refused(spark):
    df = activity(spark, ("a", 0), ("a", 3))
    state = G.growth_step(spark.createDataFrame([], PLAYERS), df, D0)
    for d in (2, 3):
        with pytest.raises(PySparkException, match="no rows of"):
            G.growth_step(state, df, D0 + timedelta(days=d)).collect()
    again = G.growth_step(state, df, D0 + timedelta(days=1))
    assert rows(G.growth_step(state.unionByName(again), df, D0 + timedelta(days=1))) == rows(again)

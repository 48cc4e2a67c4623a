"""Type-2 history: streaks, the documented fixture, NULL attributes, absence."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tideframe.operators import scd as S

SNAP = "actorid string, quality_class string, is_active boolean, current_year int"
HIST = (
    "actorid string, quality_class string, is_active boolean, start_date int, end_date int"
)


def snap(spark, *data):
    return spark.createDataFrame(list(data), SNAP)


def hist(spark, *data):
    return spark.createDataFrame(list(data), HIST)


def test_step_closes_opens_and_extends(spark):
    """k1 returns to an earlier class, k2 changes, k3 goes on, k4 is new."""
    history = hist(
        spark,
        ("k1", "star", True, 1990, 1994),
        ("k1", "average", False, 1995, 1997),
        ("k2", "bad", True, 1992, 1997),
        ("k3", "good", False, 1996, 1997),
    )
    now = snap(
        spark,
        ("k1", "star", True, 1998), ("k2", "bad", False, 1998),
        ("k3", "good", False, 1998), ("k4", "average", True, 1998),
    )
    want = [
        ("k1", "average", False, 1995, 1997, 1998),
        ("k1", "star", True, 1990, 1994, 1998),
        ("k1", "star", True, 1998, 1998, 1998),
        ("k2", "bad", False, 1998, 1998, 1998),
        ("k2", "bad", True, 1992, 1997, 1998),
        ("k3", "good", False, 1996, 1998, 1998),
        ("k4", "average", True, 1998, 1998, 1998),
    ]
    once = S.scd2_incremental(history, now, 1998)
    assert rows(once) == want
    assert rows(S.scd2_incremental(once, now, 1998)) == want  # stamped, run again
    assert rows(S.scd2_incremental(once.drop("current_year"), now, 1998)) == want
    both = S.stamp(history, 1997).unionByName(once).unionByName(S.stamp(history, 1996))
    assert rows(S.scd2_incremental(both, now, 1998)) == want  # a table of several stamps
    for changed in (S.scd2_expand_changed(h, now, 1998) for h in (history, once)):
        assert rows(changed) == [r[:-1] for r in want if r[0] in ("k1", "k2") and (r[3] == 1998 or r[4] == 1997)]


def test_skipped_year_is_refused(spark):
    history = S.stamp(hist(spark, ("a", "good", True, 2000, 2002)), 2002)
    with pytest.raises(PySparkException, match="no rows of 2003"):
        S.scd2_incremental(history, snap(spark, ("a", "good", True, 2004)), 2004).collect()
    with pytest.raises(PySparkException, match="no rows of 2003"):
        S.scd2_incremental(history, snap(spark), 2004).collect()


def test_names_go_along(spark):
    named = snap(spark, ("a", "good", True, 2000), ("a", "bad", True, 2001)).withColumn("actor", F.lit("A"))
    history = S.scd2_backfill(named.filter("current_year = 2000"), carry=("actor",))
    out = S.scd2_incremental(S.stamp(history, 2000), named, 2001, carry=("actor",))
    assert out.columns == ["actorid", "actor", "quality_class", "is_active", "start_date", "end_date", "current_year"]
    assert rows(out, "actor", "start_date") == [("A", 2000), ("A", 2001)]


def test_null_counts_as_a_value(spark):
    history = hist(
        spark,
        ("to_value", None, True, 2003, 2003),
        ("to_null", "good", True, 2003, 2003),
        ("stays_null", None, True, 2001, 2003),
    )
    now = snap(
        spark,
        ("to_value", "good", True, 2004),
        ("to_null", None, True, 2004),
        ("stays_null", None, True, 2004),
    )
    assert rows(S.scd2_incremental(history, now, 2004).drop("current_year")) == [
        ("stays_null", None, True, 2001, 2004),
        ("to_null", None, True, 2004, 2004),
        ("to_null", "good", True, 2003, 2003),
        ("to_value", None, True, 2003, 2003),
        ("to_value", "good", True, 2004, 2004),
    ]


def test_absent_key_keeps_its_last_interval(spark):
    history = hist(spark, ("gone", "good", True, 2000, 2003))
    out = S.scd2_incremental(history, snap(spark, ("new", "bad", True, 2004)), 2004)
    assert rows(out) == [
        ("gone", "good", True, 2000, 2003, 2004),
        ("new", "bad", True, 2004, 2004, 2004),
    ]


def test_backfill_splits_on_either_attribute_and_on_gaps(spark):
    out = S.scd2_backfill(
        snap(
            spark,
            ("a", "good", True, 2000), ("a", "good", True, 2001),
            ("a", "good", False, 2002), ("a", "bad", False, 2003),
            ("a", "bad", False, 2005),
        )
    )
    assert rows(out) == [
        ("a", "bad", False, 2003, 2003),
        ("a", "bad", False, 2005, 2005),
        ("a", "good", False, 2002, 2002),
        ("a", "good", True, 2000, 2001),
    ]


def test_group_summary_ignores_streaks(spark):
    out = S.scd2_group_summary(
        snap(spark, ("a", "good", True, 2000), ("a", "bad", True, 2001), ("a", "good", True, 2002))
    )
    assert rows(out) == [("a", "bad", True, 2001, 2001), ("a", "good", True, 2000, 2002)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("ab"), st.integers(2000, 2003)),
        st.tuples(st.sampled_from(["good", "bad", None]), st.booleans()),
        min_size=1,
    )
)
def test_steps_equal_backfill_and_intervals_are_disjoint(spark, cells):
    data = [(k, q, a, y) for (k, y), (q, a) in cells.items()]
    snapshots = snap(spark, *data)
    state = hist(spark)
    for year in range(2000, 2004):
        state = S.scd2_incremental(state, snapshots, year).drop("current_year")
        state = spark.createDataFrame(state.collect(), HIST)
    got = rows(S.scd2_backfill(snapshots))
    assert rows(state) == got
    covered = [(k, y) for k, _, _, s, e in got for y in range(s, e + 1)]
    assert sorted(covered) == sorted(cells)


# --- corrected snapshots of the past ---------------------------------------------

GRID = st.dictionaries(
    st.tuples(st.sampled_from("abc"), st.integers(2000, 2005)),
    st.tuples(st.sampled_from(["star", "bad", None]), st.sampled_from([True, None])), max_size=18,
)


def grid_rows(grid):
    return [(k, q, a, y) for (k, y), (q, a) in grid.items()]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(GRID, GRID)
def test_splice_is_the_backfill_of_the_corrected_snapshots(spark, stored, true):
    """For every year: the year's rows replaced whole, and only for the keys that have some."""
    history = S.scd2_backfill(snap(spark, *grid_rows(stored)))
    for t in (2000, 2002, 2005):
        new = {k: v for k, v in true.items() if k[1] == t}
        keys = {k for k, _ in new}
        for partial in (False, True):
            rest = {k: v for k, v in stored.items() if k[1] != t or (partial and k[0] not in keys)}
            want = rows(S.scd2_backfill(snap(spark, *grid_rows(rest | new))))
            once = S.scd2_splice(history, snap(spark, *grid_rows(true)), t, partial=partial)
            assert rows(once) == want, (t, partial)
    assert rows(S.scd2_splice(once, snap(spark, *grid_rows(true)), 2005, partial=True)) == want  # again


def test_splice_splits_replaces_and_rejoins(spark):
    history = hist(
        spark, ("k1", "star", True, 1990, 1999), ("k2", "bad", True, 1990, 1994), ("k2", "star", True, 1995, 1995),
        ("k2", "bad", True, 1996, 1999), ("k3", "good", True, 1980, 1985), ("k4", "bad", True, 1995, 1995),
    )
    true = snap(spark, ("k1", "bad", True, 1995), ("k2", "bad", True, 1995), ("k5", None, None, 1995),
                ("k1", "not of the year", True, 1996))
    assert rows(S.scd2_splice(S.stamp(history, 1999), true, 1995)) == [
        ("k1", "bad", True, 1995, 1995, 1999), ("k1", "star", True, 1990, 1994, 1999),
        ("k1", "star", True, 1996, 1999, 1999), ("k2", "bad", True, 1990, 1999, 1999),
        ("k3", "good", True, 1980, 1985, 1999), ("k5", None, None, 1995, 1995, 1999),
    ]


@pytest.mark.parametrize("partial", [False, True])
def test_splice_shuffles_once(spark, tmp_path, partial):
    hist(spark, ("k1", "star", True, 1990, 1999)).write.parquet(str(tmp_path / "h"))
    snap(spark, ("k1", "bad", True, 1995)).write.parquet(str(tmp_path / "s"))
    history, true = (spark.read.parquet(str(tmp_path / x)) for x in "hs")
    p = plan(S.scd2_splice(history, true, 1995, partial=partial))
    assert p.count("Exchange hashpartitioning") == 1


def test_registered_step_reads_little(spark):
    """The history and the snapshots are tables, and the year is known."""
    import __spark_entry__ as entry

    p = plan(entry.queries()["scd2_incremental"](spark, "/root/testdata/sf0.001"))
    assert p.count("FileScan parquet") <= 10 and p.count("Exchange hashpartitioning") <= 3

"""Cumulative snapshots: the documented fixture, carrying, parts, fold = backfill."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tideframe.functions import expressions as X
from tideframe.operators import cumulative as A
from tideframe.schemas import ACTOR_FILMS, ACTORS

COLS = ["actorid", "current_year", "year", "quality_class", "years_since_film", "is_active"]


def films(spark, *items):
    """(actorid, year, rating) or with a filmid as fourth."""
    data = []
    for i, (actor, year, rating, *fid) in enumerate(items):
        fid = fid[0] if fid else f"f{i:03d}"
        data.append((actor.upper(), actor, year, f"Film {fid}", 10 + i, rating, fid))
    return spark.createDataFrame(data, ACTOR_FILMS)


def filmids(df):
    return df.withColumn("films", F.col("films")["filmid"])


@pytest.mark.parametrize(
    "rating,expected",
    [(8.5, "star"), (8.0, "good"), (7.5, "good"), (7.0, "average"), (6.0, "bad"), (None, "bad")],
)
def test_class_bounds_are_exclusive(spark, rating, expected):
    df = spark.createDataFrame([(rating,)], "r double")
    assert df.select(X.quality_class(F.col("r"))).first()[0] == expected


def _state(spark, *data):
    return spark.createDataFrame(list(data), ACTORS)


def test_step_updates_carries_and_adds(spark):
    prev = _state(
        spark,
        ("P", "p1", 1997, 0, [("Old p", 3, 2.0, "x1")], "bad", 1, 1998, False),
        ("Q", "p2", 1998, 0, [("Old q", 4, 8.4, "x2")], "star", 0, 1998, True),
        ("R", "p3", 1998, 0, [], "good", 0, 1998, True),
    )
    new = films(
        spark, ("p1", 1999, 6.4, "y1"), ("p1", 1999, 8.4, "y2"), ("p3", 1999, 5.5, "y3"),
        ("p9", 1999, 8.1, "y4"), ("p2", 1998, 1.0, "y5"),
    )
    want = [
        ("p1", 1999, 1999, "good", 0, True, ("x1", "y1", "y2")),
        ("p2", 1999, 1998, "star", 1, False, ("x2",)),
        ("p3", 1999, 1999, "bad", 0, True, ("y3",)),
        ("p9", 1999, 1999, "star", 0, True, ("y4",)),
    ]
    out = A.actor_step(prev, new, 1999)
    assert out.columns == ACTORS.fieldNames()
    assert rows(filmids(out), *COLS, "films") == want
    again = A.actor_step(prev.unionByName(_state(spark, *out.collect())), new, 1999)
    assert rows(filmids(again), *COLS, "films") == want  # run again over the whole table


def test_skipped_year_is_refused(spark):
    prev = _state(spark, ("P", "p1", 1997, 0, [], "bad", 1, 1998, False))
    for new in (films(spark, ("p1", 2000, 9.0)), films(spark, ("p1", 1990, 9.0))):
        with pytest.raises(PySparkException, match="no rows of 1999"):
            A.actor_step(prev, new, 2000).collect()


def test_idle_actor_is_carried_every_year(spark):
    out = A.actor_backfill(films(spark, ("a", 2000, 9.0), ("b", 2003, 5.0)))
    assert rows(out.filter("actorid = 'a'"), *COLS) == [
        ("a", 2000, 2000, "star", 0, True),
        ("a", 2001, 2000, "star", 1, False),
        ("a", 2002, 2000, "star", 2, False),
        ("a", 2003, 2000, "star", 3, False),
    ]


def test_films_of_one_year_are_averaged_and_kept(spark):
    out = A.actor_backfill(films(spark, ("a", 2000, 9.0), ("a", 2000, 5.0)))
    assert rows(filmids(out), "quality_class", "films") == [("average", ("f000", "f001"))]


def _fold(spark, df, first, last, parts):
    state = spark.createDataFrame([], ACTORS)
    for year in range(first, last + 1):
        state = A.actor_step(state, df, year, parts)
        state = spark.createDataFrame(state.collect(), ACTORS)
    return state


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from("abc"), st.integers(2000, 2003),
            st.sampled_from([5.0, 6.5, 7.5, 9.0]),
        ),
        min_size=1, max_size=12,
    ),
    st.sampled_from([1, 3]),
)
def test_steps_equal_backfill(spark, items, parts):
    df = films(spark, *items)
    by_step = _fold(spark, df, 2000, 2003, parts)
    whole = A.actor_backfill(df, 2003, parts).filter("current_year = 2003")
    order = ["films_part", *COLS, "films"]
    assert rows(filmids(by_step), *order) == rows(filmids(whole), *order)


def test_grain_does_not_depend_on_the_data(spark):
    """20,000 films of one actor and year are one row; parts are the caller's."""
    df = spark.range(20_000).select(
        F.lit("H").alias("actor"), F.lit("hot").alias("actorid"), F.lit(2000).alias("year"),
        F.col("id").cast("string").alias("film"), F.lit(1).alias("votes"),
        F.lit(7.5).alias("rating"), F.col("id").cast("string").alias("filmid"),
    )
    assert rows(A.actor_backfill(df).select("films_part", F.size("films").alias("n"))) == [(0, 20_000)]


def test_large_actor_is_split_and_kept_whole(spark):
    items = [("hot", 2000 + i % 3, float(i % 10)) for i in range(300)] + [("b", 2001, 7.5)]
    df = films(spark, *items)
    split = A.actor_backfill(df, parts=10)
    whole = A.actor_backfill(df)
    parts = split.filter("actorid = 'hot' and current_year = 2002")
    assert parts.count() == 10
    # the attributes are the same on all parts
    assert parts.select(*COLS).distinct().count() == 1

    def flat(d):
        return rows(
            d.select(*COLS, F.explode("films.filmid").alias("filmid")), *COLS, "filmid"
        )

    assert flat(split) == flat(whole)
    assert split.filter("actorid = 'b'").count() == 2


def test_given_last_year_over_generated_rows(spark):
    """A literal last year lets Spark prune the generators; none may break."""
    df = spark.range(200).select(
        F.lit("n").alias("actor"), (F.col("id") % 7).alias("actorid"),
        (F.col("id") % 5 + 2000).cast("int").alias("year"),
        F.col("id").cast("string").alias("film"), F.lit(1).alias("votes"),
        F.lit(7.5).alias("rating"), F.col("id").cast("string").alias("filmid"),
    )
    out = A.actor_backfill(df, 2006)
    assert out.count() == 7 * 7 and out.filter("quality_class = 'good'").count() == 49

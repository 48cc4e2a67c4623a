"""Cumulative yearly snapshots of actors.

A snapshot row holds the films of an actor so far.  The caller may split every
actor's films over a fixed number of ``parts`` by a hash of the film; the key of
a snapshot is then (actorid, films_part, current_year).  With one part, the
default, it is (actorid, current_year).  The attributes are the same on every
part, so each row can be read on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions import expressions as X
from tideframe.operators.guards import require_previous
from tideframe.schemas import ACTORS, FILM

ATTRIBUTES = ["actor", "year", "quality_class", "years_since_film"]


def _film() -> Column:
    return F.struct(*[F.col(c).cast(FILM[c].dataType).alias(c) for c in FILM.fieldNames()])


def _sorted_films(by_year: bool) -> Column:
    """Films in the order of year and filmid, still with their sort key."""
    key = ["year", "filmid"] if by_year else ["filmid"]
    return F.sort_array(F.collect_list(F.struct(*key, _film().alias("film_row"))))


def _with_part(films: DataFrame, parts: int) -> DataFrame:
    """Adds films_part, a hash of the film below ``parts``."""
    part = F.pmod(F.xxhash64("filmid"), F.lit(parts)).cast("int") if parts > 1 else F.lit(0)
    return films.withColumn("films_part", part)


def _year_values(films: DataFrame) -> list[Column]:
    """What a year's films say about the actor: average rating and, if there, name."""
    name = [F.max("actor").alias("actor")] if "actor" in films.columns else []
    return [F.avg("rating").alias("rating"), *name]


def actor_years(films: DataFrame) -> DataFrame:
    """(actorid, year, rating[, actor])."""
    return films.groupBy("actorid", "year").agg(*_year_values(films))


def actor_attributes(
    films: DataFrame,
    last_year: int | Column | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """Snapshots without the films: one narrow row per actor and year.

    ``year`` is the year of the latest film, ``current_year`` the snapshot's.
    Idle years repeat the latest class.  The years of an actor are at most the
    calendar's, so collecting them is bounded.  Names come from the films or,
    joined once per actor, from ``names``; with neither there is no ``actor``.
    """
    years = actor_years(films)
    values = years.columns[2:]
    if last_year is None:
        last_year = films.agg(F.max("year").alias("y")).scalar()
    elif isinstance(last_year, int):
        last_year = F.lit(last_year)
    per_actor = years.groupBy("actorid").agg(
        F.sort_array(F.collect_list(F.struct("year", *values))).alias("active")
    )
    names_joined = []
    if names is not None:
        per_actor = per_actor.join(names, "actorid", "left")
        names_joined = ["actor"]
    # The struct is taken apart before the second generator: nested fields used
    # on both sides of an explode trip Spark's pruning of generators.
    steps = (
        per_actor.withColumn("last_year", last_year)
        .select("actorid", "active", "last_year", *names_joined, F.posexplode("active"))
        .select(
            "actorid",
            *[F.col(f"col.{c}").alias(c) for c in ("year", *values)],
            (F.get("active", F.col("pos") + 1)["year"] - 1).alias("before_next"),
            "last_year",
            *names_joined,
        )
        .filter("year <= last_year")
    )
    until = F.least(F.coalesce("before_next", "last_year"), "last_year")
    rows = steps.withColumn("current_year", F.explode(F.sequence("year", until)))
    idle = F.col("current_year") - F.col("year")
    return rows.select(
        "actorid",
        *[c for c in rows.columns if c == "actor"],
        "year",
        X.quality_class(F.col("rating")).alias("quality_class"),
        idle.alias("years_since_film"),
        "current_year",
        (idle == 0).alias("is_active"),
    )


def actor_backfill(
    films: DataFrame,
    last_year: int | Column | None = None,
    parts: int = 1,
    names: DataFrame | None = None,
) -> DataFrame:
    """All snapshots up to ``last_year`` in one pass.

    With one part the films are shuffled once, by actor, and the join with the
    attributes needs no further shuffle.
    """
    attributes = actor_attributes(films, last_year, names)
    grouped = (
        _with_part(films, parts).groupBy("actorid", "films_part")
        .agg(_sorted_films(by_year=True).alias("all_films"))
    )
    first = F.col("all_films")[0]["year"]
    so_far = F.filter("all_films", lambda f: f["year"] <= F.col("current_year"))
    return (
        grouped.join(attributes, "actorid")
        .filter(first <= F.col("current_year"))
        .withColumn("films", so_far["film_row"])
        .select(*ACTORS.fieldNames())
    )


def actor_step(
    prev: DataFrame,
    films: DataFrame,
    year: int | Column,
    parts: int = 1,
    names: DataFrame | None = None,
) -> DataFrame:
    """Snapshot of ``year`` from the snapshot of the year before.

    Actors without a film are carried; actors first seen this year are added.
    ``parts`` is that of the state.  With one part, one outer join by actor
    does it, and the state is shuffled once, or not at all when it is bucketed
    by actor.  With more, the outer join is by part, so that a large actor is
    spread over tasks, and the attributes come in by a left join, which AQE can
    split.  A state without the year before is refused, unless it is empty.
    """
    year = F.lit(year)
    y = prev.filter(F.col("current_year") == year - 1).select(
        "actorid", "films_part", "films",
        *[F.col(c).alias(f"old_{c}") for c in ATTRIBUTES],
    )
    today = _with_part(films.filter(F.col("year") == year), parts)
    new_films = _sorted_films(by_year=False)["film_row"].alias("new_films")

    def seen_today(values: DataFrame) -> DataFrame:
        if names is not None:
            values = values.join(names, "actorid", "left")
        return values.withColumnRenamed("actor", "new_actor").withColumn("seen", F.lit(True))

    if parts == 1:
        new = today.groupBy("actorid").agg(new_films, *_year_values(today))
        rows = (
            y.drop("films_part")
            .join(seen_today(new), "actorid", "full_outer")
            .withColumn("films_part", F.lit(0))
        )
    else:
        new = today.groupBy("actorid", "films_part").agg(new_films)
        # All parts of an actor must learn that the actor was seen this year,
        # also those that get none of the new films: attributes join by actor.
        values = today.groupBy("actorid").agg(*_year_values(today))
        rows = y.join(new, ["actorid", "films_part"], "full_outer").join(
            seen_today(values), "actorid", "left"
        )
    none = F.array().cast(ACTORS["films"].dataType)
    seen = F.col("seen").isNotNull()
    result = rows.select(
        F.coalesce("new_actor", "old_actor").alias("actor"),
        "actorid",
        F.when(seen, year).otherwise(F.col("old_year")).alias("year"),
        "films_part",
        F.concat(F.coalesce("films", none), F.coalesce("new_films", none)).alias("films"),
        F.when(seen, X.quality_class(F.col("rating")))
        .otherwise(F.col("old_quality_class"))
        .alias("quality_class"),
        F.when(seen, F.lit(0)).otherwise(F.col("old_years_since_film") + 1)
        .alias("years_since_film"),
        year.alias("current_year"),
        seen.alias("is_active"),
    )
    return require_previous(result, prev, "current_year", year - 1)

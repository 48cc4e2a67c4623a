"""From activity days to one row per entity and snapshot.

The building block of the date lists and of growth accounting.  Days are made
distinct per entity with map-side combine before anything is grouped, so an
entity's list is bounded by the calendar however many events it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions import expressions as X


def activity_days(
    events: DataFrame, key: str, ts: str = "event_time", keep_null_key: bool = False
) -> DataFrame:
    """Distinct (key, day) of the events."""
    days = events.select(F.col(key), X.day(ts).alias("day")).filter("day is not null")
    if not keep_null_key:
        days = days.filter(F.col(key).isNotNull())
    return days.distinct()


def date_lists(days: DataFrame, key: str) -> DataFrame:
    """(key, dates): all active days of an entity, oldest first."""
    return days.groupBy(key).agg(F.sort_array(F.collect_list("day")).alias("dates"))


def stretches(lists: DataFrame, key: str, as_of: Column) -> DataFrame:
    """One row per activity day up to ``as_of``, with the day until which it is the latest.

    Columns: key, dates, pos (index of the activity day), last_active,
    next_active, previous_active, as_of, until.
    """
    return (
        lists.withColumn("as_of", as_of)
        .select("*", F.posexplode("dates").alias("pos", "last_active"))
        .filter(F.col("last_active") <= F.col("as_of"))
        .withColumn("next_active", F.get("dates", F.col("pos") + 1))
        .withColumn("previous_active", F.get("dates", F.col("pos") - 1))
        .withColumn(
            "until",
            F.least(F.coalesce(F.date_sub("next_active", 1), F.col("as_of")), "as_of"),
        )
    )


def timeline(lists: DataFrame, key: str, as_of: Column) -> DataFrame:
    """One row per entity and day from its first day to ``as_of``.

    An activity day stays the latest one until the day before the next, so each
    is expanded over exactly that stretch: two generators, no join with a
    calendar, no window and no shuffle.

    Columns: key, dates, pos (index of the latest activity day), last_active,
    previous_active, snapshot.
    """
    return stretches(lists, key, as_of).select(
        key, "dates", "pos", "last_active", "previous_active",
        F.explode(X.days_between(F.col("last_active"), F.col("until"))).alias("snapshot"),
    )

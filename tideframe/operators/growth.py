"""Growth accounting: how an entity's state changes from day to day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideframe.functions import expressions as X
from tideframe.operators import timeline as TL
from tideframe.operators.guards import require_previous

NAME = "player_name"


def _daily_state(is_new: Column, last: Column, today: Column, d: Column) -> Column:
    """State on day ``d``; ``last`` is the latest active day before it."""
    yesterday = F.date_sub(d, 1)
    return (
        F.when(is_new, F.lit(X.NEW))
        .when(today.isNotNull() & (last == yesterday), F.lit(X.CONTINUED))
        .when(today.isNotNull(), F.lit(X.RETURNED))
        .when(last == yesterday, F.lit(X.RETIRED))
        .otherwise(F.lit(X.STAYED_RETIRED))
    )


def _yearly_state(is_new: Column, last: Column, today: Column, d: Column) -> Column:
    return (
        F.when(is_new, F.lit(X.NEW))
        .when(
            today.isNotNull() & (last < F.date_sub(d, X.YEARLY_ABSENCE_DAYS)),
            F.lit(X.RETURNED),
        )
        .when(today.isNull(), F.lit(X.RETIRED))
        .otherwise(F.lit(X.CONTINUED))
    )


def growth_backfill(
    activity: DataFrame,
    as_of: date | Column | None = None,
    day_col: str = "effective_date",
) -> DataFrame:
    """Every snapshot up to ``as_of`` with daily and yearly state."""
    days = TL.activity_days(X.up_to(activity, day_col, as_of), NAME, day_col)
    end = X.latest(days, F.col("day")) if as_of is None else X.as_date(as_of)
    grid = TL.timeline(TL.date_lists(days, NAME), NAME, end)
    d = F.col("snapshot")
    active = F.col("last_active") == d
    last = F.when(active, F.col("previous_active")).otherwise(F.col("last_active"))
    today = F.when(active, d)
    is_new = active & F.col("previous_active").isNull()
    return grid.select(
        NAME,
        F.get("dates", F.lit(0)).alias("first_active_date"),
        F.col("last_active").alias("last_active_date"),
        _daily_state(is_new, last, today, d).alias("daily_active_state"),
        _yearly_state(is_new, last, today, d).alias("yearly_active_state"),
        F.slice("dates", F.lit(1), F.col("pos") + 1).alias("dates_active"),
        d.alias("date"),
    )


def growth_step(
    prev: DataFrame, activity: DataFrame, d: date | Column, day_col: str = "effective_date"
) -> DataFrame:
    """Snapshot of ``d`` from the snapshot of the day before and today's activity.

    A state without the snapshot of ``d - 1`` is refused, unless it is empty.
    """
    today = X.as_date(d)
    y = (
        prev.filter(F.col("date") == F.date_sub(today, 1))
        .select(
            NAME, "first_active_date", "last_active_date", "dates_active",
            F.lit(True).alias("known"),
        )
    )
    t = TL.activity_days(
        activity.filter(X.on_day(day_col, today)), NAME, day_col
    ).withColumnRenamed("day", "active_on")
    is_new = F.col("known").isNull()
    on, last = F.col("active_on"), F.col("last_active_date")
    none = F.array().cast("array<date>")
    result = y.join(t, NAME, "full_outer").select(
        NAME,
        F.coalesce("first_active_date", on).alias("first_active_date"),
        F.coalesce(on, last).alias("last_active_date"),
        _daily_state(is_new, last, on, today).alias("daily_active_state"),
        _yearly_state(is_new, last, on, today).alias("yearly_active_state"),
        F.concat(
            F.coalesce("dates_active", none),
            F.when(on.isNotNull(), F.array(on)).otherwise(none),
        ).alias("dates_active"),
        today.alias("date"),
    )
    return require_previous(result, prev, "date", F.date_sub(today, 1))


def growth_snapshot(
    activity: DataFrame, as_of: date | Column, day_col: str = "effective_date"
) -> DataFrame:
    """The one snapshot of ``as_of``, without the days before it."""
    d = X.as_date(as_of)
    days = TL.activity_days(X.up_to(activity, day_col, as_of), NAME, day_col)
    lists = TL.date_lists(days.filter(F.col("day") <= d), NAME)
    latest = F.element_at("dates", -1)
    earlier = F.try_element_at("dates", F.lit(-2))
    active = latest == d
    last = F.when(active, earlier).otherwise(latest)
    today = F.when(active, d)
    is_new = active & earlier.isNull()
    return lists.select(
        NAME,
        F.element_at("dates", 1).alias("first_active_date"),
        latest.alias("last_active_date"),
        _daily_state(is_new, last, today, d).alias("daily_active_state"),
        _yearly_state(is_new, last, today, d).alias("yearly_active_state"),
        F.col("dates").alias("dates_active"),
        d.alias("date"),
    )


def growth_counts(
    activity: DataFrame,
    state: str = "daily_active_state",
    as_of: date | Column | None = None,
    day_col: str = "effective_date",
) -> DataFrame:
    """(date, <state>, entities) of every day, without a row per entity and day.

    An entity enters a state on some day and leaves it on another: two changes
    per stretch, added up per state and day with map-side combine.  Running
    sums over the calendar give the counts, so that only the number of days
    decides how many rows there are after the first shuffle.
    """
    days = TL.activity_days(X.up_to(activity, day_col, as_of), NAME, day_col)
    end = X.latest(days, F.col("day")) if as_of is None else X.as_date(as_of)
    steps = TL.stretches(TL.date_lists(days, NAME), NAME, end)
    day, until = F.col("last_active"), F.col("until")
    is_new = F.col("previous_active").isNull()
    first = (_daily_state if state == "daily_active_state" else _yearly_state)(
        is_new, F.col("previous_active"), day, day
    )

    def stretch(name: Column, a: Column, b: Column) -> Column:
        return F.struct(name.alias("state"), a.alias("a"), b.alias("b"))

    next_day = F.date_add(day, 1)
    if state == "daily_active_state":
        idle = [
            stretch(F.lit(X.RETIRED), next_day, next_day),
            stretch(F.lit(X.STAYED_RETIRED), F.date_add(day, 2), until),
        ]
    else:
        idle = [stretch(F.lit(X.RETIRED), next_day, until)]
    parts = F.filter(F.array(stretch(first, day, day), *idle), lambda s: (s["a"] <= s["b"]) & (s["a"] <= until))
    changes = (
        steps.select(F.inline(parts))
        .select("state", F.inline(F.array(
            F.struct(F.col("a").alias("day"), F.lit(1).alias("change")),
            F.struct(F.date_add("b", 1).alias("day"), F.lit(-1).alias("change")),
        )))
        .groupBy("state", "day").agg(F.sum("change").alias("change"))
    )
    w = Window.partitionBy("state").orderBy("day")
    levels = (
        changes.withColumn("entities", F.sum("change").over(w))
        .withColumn("last", F.date_sub(F.lead("day").over(w), 1))
        .filter("entities > 0 and last >= day")
    )
    return levels.select(
        F.explode(X.days_between(F.col("day"), F.col("last"))).alias("date"),
        F.col("state").alias(state), "entities",
    )


def latest_activity(activity: DataFrame, season: int | None = None) -> DataFrame:
    """Latest effective date per player, of one season or of each."""
    rows = activity if season is None else activity.filter(
        F.col("current_season") == season
    )
    return rows.groupBy(NAME, "current_season").agg(
        F.max("effective_date").alias("today_date")
    )

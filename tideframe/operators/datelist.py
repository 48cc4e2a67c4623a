"""Activity date lists per device or host, and their 32-day bit form."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions import expressions as X
from tideframe.operators import timeline as TL
from tideframe.operators.guards import require_previous


def datelist_backfill(
    events: DataFrame,
    key: str,
    list_name: str,
    as_of: date | Column | None = None,
    ts: str = "event_time",
) -> DataFrame:
    """All snapshots up to ``as_of``: (key, <list_name>, date).

    Rows with a NULL key are dropped; an idle entity is carried with its list
    unchanged.  The shuffles move distinct (key, day) pairs, not events.
    """
    days = TL.activity_days(X.up_to(events, ts, as_of), key, ts)
    end = X.latest(days, F.col("day")) if as_of is None else X.as_date(as_of)
    grid = TL.timeline(TL.date_lists(days, key), key, end)
    return grid.select(
        key,
        F.slice("dates", F.lit(1), F.col("pos") + 1).alias(list_name),
        F.col("snapshot").alias("date"),
    )


def datelist_snapshot(
    events: DataFrame,
    key: str,
    list_name: str,
    as_of: date | Column | None = None,
    ts: str = "event_time",
) -> DataFrame:
    """The one snapshot of ``as_of``, without the days before it."""
    days = TL.activity_days(X.up_to(events, ts, as_of), key, ts)
    end = X.latest(events, X.day(ts)) if as_of is None else X.as_date(as_of)
    rows = days.withColumn("date", end).filter("day <= date")
    return rows.groupBy(key, "date").agg(
        F.sort_array(F.collect_list("day")).alias(list_name)
    ).select(key, list_name, "date")


def datelist_step(
    prev: DataFrame,
    events: DataFrame,
    key: str,
    list_name: str,
    d: date | Column,
    ts: str = "event_time",
) -> DataFrame:
    """Snapshot of day ``d`` from the snapshot of the day before.

    ``prev`` may be the whole state table: only the partition of ``d - 1`` is
    read.  Running the step again for the same day gives the same rows.  A
    state without the snapshot of ``d - 1`` is refused, unless it is empty.
    """
    today = X.as_date(d)
    y = prev.filter(F.col("date") == F.date_sub(today, 1)).select(key, list_name)
    t = (
        TL.activity_days(events.filter(X.on_day(ts, today)), key, ts)
        .withColumnRenamed("day", "active_on")
    )
    old = F.coalesce(F.col(list_name), F.array().cast("array<date>"))
    new = F.when(
        F.col("active_on").isNull() | F.array_contains(old, F.col("active_on")),
        F.array().cast("array<date>"),
    ).otherwise(F.array("active_on"))
    result = y.join(t, key, "full_outer").select(
        key, F.concat(old, new).alias(list_name), today.alias("date")
    )
    return require_previous(result, prev, "date", F.date_sub(today, 1))


def datelist_bits(snapshot: DataFrame, key: str, list_name: str) -> DataFrame:
    """Bit form of stored date lists: a narrow pass, no join with a calendar."""
    bits = X.list_bits(F.col(list_name), F.col("date"))
    return snapshot.select(
        key, F.col("date"), bits.alias("datelist_bits")
    ).withColumn("datelist_int", X.bit_string(F.col("datelist_bits")))


def activity_bits(
    events: DataFrame,
    key: str,
    as_of: date | Column | None = None,
    ts: str = "event_time",
) -> DataFrame:
    """Bit form straight from events, without building lists.

    OR of one bit per event is a hash aggregate over eight bytes per entity
    with map-side combine: one shuffle of at most one row per entity and map
    task, whatever the skew.  Entities idle for 32 days keep a zero string.
    """
    days = X.up_to(events, ts, as_of).select(key, X.day(ts).alias("day")).filter(
        F.col(key).isNotNull() & F.col("day").isNotNull()
    )
    end = X.latest(days, F.col("day")) if as_of is None else X.as_date(as_of)
    rows = days.withColumn("date", end).filter("day <= date")
    return (
        rows.groupBy(key, "date")
        .agg(F.bit_or(X.day_bit(F.col("date"), F.col("day"))).alias("datelist_bits"))
        .withColumn("datelist_int", X.bit_string(F.col("datelist_bits")))
    )


def calendar_grid(
    snapshot: DataFrame, key: str, list_name: str, days: int = X.DATELIST_BITS
) -> DataFrame:
    """One row per entity and calendar day before the snapshot, with its value.

    The calendar is generated per row; there is no cross join.
    """
    first = F.date_sub("date", days - 1)
    grid = snapshot.select(
        key, "date", list_name,
        F.explode(X.days_between(first, F.col("date"))).alias("series_date"),
    )
    value = F.when(
        F.array_contains(list_name, F.col("series_date")),
        X.day_bit(F.col("date"), F.col("series_date")),
    ).otherwise(F.lit(0).cast("bigint"))
    return grid.select(key, "date", "series_date", value.alias("placeholder_int_value"))


def active_days_bits(bits: DataFrame, key: str) -> DataFrame:
    """Days active on the snapshot day, in the last 7 and in the last 28 days."""
    b = F.col("datelist_bits")
    return bits.select(
        key,
        X.active_days(b, 1).alias("active_today"),
        X.active_days(b, 7).alias("active_7d"),
        X.active_days(b, 28).alias("active_28d"),
    )

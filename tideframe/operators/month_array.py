"""Daily counts of a month as one positional array per host."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions import expressions as X

# Fixed value: name of the metric.
SITE_HITS = "site_hits"

KEY = ["host", "month_start", "metric_name"]


def daily_hits(events: DataFrame, ts: str = "event_time") -> DataFrame:
    """(host, day, hits); partial counts leave the map side, not events."""
    return (
        events.select("host", X.day(ts).alias("day"))
        .filter("host is not null and day is not null")
        .groupBy("host", "day")
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def host_month_array(
    events: DataFrame, as_of: date | Column | None = None, ts: str = "event_time"
) -> DataFrame:
    """State after day ``as_of``: one array per host and month.

    Element i is the count of day i; days without hits are 0 and the array ends
    at ``as_of`` or at the end of the month.  A host has no row for a month in
    which it was never seen.
    """
    hits = daily_hits(X.up_to(events, ts, as_of), ts)
    end = X.latest(hits, F.col("day")) if as_of is None else X.as_date(as_of)
    month = (
        hits.withColumn("as_of", end)
        .filter("day <= as_of")
        .groupBy("host", X.month_start("day").alias("month_start"), "as_of")
        .agg(
            # at most 31 entries: one per day of the month
            F.map_from_entries(
                F.collect_list(F.struct(F.dayofmonth("day"), "hits"))
            ).alias("by_day")
        )
    )
    n_days = F.dayofmonth(F.least(F.last_day("month_start"), F.col("as_of")))
    return month.select(
        "host",
        "month_start",
        F.lit(SITE_HITS).alias("metric_name"),
        F.transform(
            F.sequence(F.lit(1), n_days),
            lambda i: F.coalesce(F.try_element_at("by_day", i), F.lit(0).cast("bigint")),
        ).alias("metric_array"),
    )


def host_month_step(
    prev: DataFrame, events: DataFrame, d: date | Column, ts: str = "event_time"
) -> DataFrame:
    """Rows to upsert for day ``d``: arrays of its month with ``d`` appended.

    The array length says which day a row has reached.  A rerun of ``d``
    replaces its element and keeps later ones; a skipped day is refused,
    because the step cannot know the counts in between (use the backfill).
    """
    today = X.as_date(d)
    t = daily_hits(events.filter(X.on_day(ts, today)), ts).select("host", "hits")
    y = prev.filter(
        (F.col("month_start") == X.month_start(today))
        & (F.col("metric_name") == SITE_HITS)
    ).select("host", "metric_array")

    before = F.dayofmonth(today) - 1
    zero = F.lit(0).cast("bigint")
    kept = (
        F.when(F.col("metric_array").isNull(), F.array_repeat(zero, before))
        .when(
            F.size("metric_array") >= before,
            F.slice("metric_array", F.lit(1), before),
        )
        .otherwise(
            F.raise_error(
                F.concat(
                    F.lit("month array of host "), F.col("host"),
                    F.lit(" ends before the day preceding "), today.cast("string"),
                )
            ).cast("array<bigint>")
        )
    )
    later = F.coalesce(
        F.slice("metric_array", before + 2, F.greatest(F.size("metric_array") - before - 1, F.lit(0))),
        F.array().cast("array<bigint>"),
    )
    return y.join(t, "host", "full_outer").select(
        "host",
        X.month_start(today).alias("month_start"),
        F.lit(SITE_HITS).alias("metric_name"),
        F.concat(kept, F.array(F.coalesce("hits", zero)), later).alias("metric_array"),
    )


def month_array_explode(arrays: DataFrame) -> DataFrame:
    """Sum over hosts per day: (metric_name, date, value).

    Positions are summed with map-side combine, so the shuffle carries at most
    31 rows per metric, month and map task.
    """
    return (
        arrays.select(
            "metric_name", "month_start", F.posexplode("metric_array").alias("pos", "hits")
        )
        .groupBy("metric_name", "month_start", "pos")
        .agg(F.sum("hits").alias("value"))
        .select("metric_name", F.date_add("month_start", F.col("pos")).alias("date"), "value")
    )

"""Data-quality checks; each returns rows that describe what it found."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions import expressions as X
from tideframe.functions.joins import null_safe

TRAILING_DAYS = 7
DEVIATIONS = 3


def _daily(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.select(X.day(ts).alias("day"))
        .filter("day is not null")
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def freshness(
    df: DataFrame, source: str, ts: str, expected: date | Column
) -> DataFrame:
    """Last day with data, how late it is, and how many days are missing."""
    days = _daily(df, ts)
    out = days.agg(
        F.min("day").alias("first_date"),
        F.max("day").alias("last_date"),
        F.count(F.lit(1)).alias("days"),
    )
    return out.select(
        F.lit(source).alias("source"),
        "last_date",
        F.datediff(X.as_date(expected), F.col("last_date")).cast("bigint").alias("days_late"),
        (F.datediff("last_date", "first_date") + 1 - F.col("days")).alias("missing_days"),
    )


def missing_days(df: DataFrame, ts: str) -> DataFrame:
    """Days between the first and the last one that have no rows.

    The distinct days, at most the calendar's, meet in one row; the table is
    read once.
    """
    present = F.collect_list("day")
    calendar = X.days_between(F.min("day"), F.max("day"))
    return (
        _daily(df, ts)
        .agg(F.array_except(calendar, present).alias("days"))
        .select(F.explode("days").alias("day"))
    )


def schema_differences(df: DataFrame, declared: T.StructType, table: str) -> DataFrame:
    """One row per declared or present column: status and number of NULLs.

    Status is 'ok', 'missing', 'unexpected' or 'type'.  NULLs of all columns
    are counted in one pass.
    """
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in declared}
    names = list(wanted) + [n for n in actual if n not in wanted]

    def status(n: str) -> str:
        if n not in actual:
            return "missing"
        if n not in wanted:
            return "unexpected"
        return "ok" if actual[n] == wanted[n] else "type"

    counts = df.agg(
        *[F.count_if(F.col(n).isNull()).alias(f"n_{i}") if n in actual
          else F.lit(None).cast("bigint").alias(f"n_{i}")
          for i, n in enumerate(names)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(n).alias("column_name"),
                F.lit(status(n)).alias("status"),
                F.col(f"n_{i}").alias("null_rows"),
            )
            for i, n in enumerate(names)
        ]
    )
    return counts.select(F.inline(rows))


def unique_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
    )


def domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows and share of values outside the allowed set; NULL is outside."""
    ok = F.coalesce(F.col(column).isin(allowed), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(~ok).alias("bad_rows")
    ).select(
        F.lit(column).alias("column_name"),
        "row_count",
        "bad_rows",
        (F.col("bad_rows") / F.nullif("row_count", F.lit(0))).alias("bad_share"),
    )


def spikes(df: DataFrame, ts: str, by: str | None = None) -> DataFrame:
    """Days whose count leaves the mean of the days before by 3 deviations.

    Counts come first; the window sees one row per day.  Without ``by`` that
    is one sequence of days, bounded by the calendar.
    """
    keys = [by] if by else []
    counts = (
        df.select(*keys, X.day(ts).alias("day"))
        .filter("day is not null")
        .groupBy(*keys, "day")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(-TRAILING_DAYS, -1)
    mean, dev = F.avg("n").over(w), F.stddev_pop("n").over(w)
    full = F.count(F.lit(1)).over(w) == TRAILING_DAYS
    return counts.select(
        *keys, "day", "n",
        F.when(full, mean).alias("trailing_mean"),
        F.coalesce(
            full & (F.abs(F.col("n") - mean) > DEVIATIONS * dev), F.lit(False)
        ).alias("is_spike"),
    )


#: A spike is this many robust deviations from the median; 1.4826 makes the
#: median deviation of normal values a standard deviation.
ROBUST_DEVIATIONS, NORMAL = 5, 1.4826
#: Registers of a quantile sketch; ranks are off by about 1.3 %.
SKETCH_K = 200


def _weekdays(df: DataFrame, ts: str, by: str) -> DataFrame:
    counts = (
        df.select(by, X.day(ts).alias("day"))
        .filter("day is not null")
        .groupBy(by, "day")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.withColumn("weekday", F.dayofweek("day"))


def robust_spikes(df: DataFrame, ts: str, by: str, sketch: bool = False) -> DataFrame:
    """Days whose count is far from the median of its source and weekday.

    Distances are measured in median absolute deviations, so that a spike does
    not widen the band it is judged by, as it does a standard deviation.  Where
    half of the days are equal, the deviation is 0 and any other day is a spike.

    Counts per source and day come first.  The exact medians hold a source's
    days of one weekday in a task.  With ``sketch`` they come from mergeable
    quantile sketches, which suit sources of finer grain than days.
    """
    counts = _weekdays(df, ts, by)
    keys = [by, "weekday"]

    def middle(values: str) -> Column:
        if sketch:
            whole = F.kll_sketch_agg_double(F.col(values).cast("double"), F.lit(SKETCH_K))
            return F.kll_sketch_get_quantile_double(whole, F.lit(0.5))
        return F.percentile(values, 0.5)

    def beside(rows: DataFrame, found: DataFrame) -> DataFrame:
        other = found.select(*[F.col(k).alias(f"of_{k}") for k in keys], *[c for c in found.columns if c not in keys])
        return rows.join(other, null_safe({k: f"of_{k}" for k in keys})).drop(*[f"of_{k}" for k in keys])

    near = beside(counts, counts.groupBy(*keys).agg(middle("n").alias("median")))
    far = near.withColumn("off", F.abs(F.col("n") - F.col("median")))
    out = beside(far, far.groupBy(*keys).agg(middle("off").alias("deviation")))
    return out.select(
        by, "day", "n", "median", "deviation",
        (F.col("off") > ROBUST_DEVIATIONS * NORMAL * F.col("deviation")).alias("is_spike"),
    )


def all_of(frames: list[DataFrame]) -> DataFrame:
    """Union of check results by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)

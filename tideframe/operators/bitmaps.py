"""Active users per day, week and month from bitmaps.

Users with whole-number ids fall into buckets of 32,768; a day's users in a
bucket are one bitmap of 4 KB, however many events they made.  Windows of days
are ORs of bitmaps.  After the first shuffle there is one row per day and
bucket, so events are never made distinct by user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideframe.functions import expressions as X

#: Days of the windows: today, a week, four weeks.
SPANS = (1, 7, 28)


def daily_bitmaps(events: DataFrame, user: str = "user_id", day: str = "day") -> DataFrame:
    """(day, bucket, users): one bitmap per day and bucket of ids, with map-side combine.

    Rows without a user or day are left out.
    """
    return (
        events.filter(F.col(user).isNotNull() & F.col(day).isNotNull())
        .groupBy(F.col(day).alias("day"), F.bitmap_bucket_number(user).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))
    )


def merge_bitmaps(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Two tables of daily bitmaps as one; a user in both counts once."""
    return older.unionByName(newer).groupBy("day", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def active_users(bitmaps: DataFrame, spans: tuple[int, ...] = SPANS) -> DataFrame:
    """(day, active_1d, active_7d, active_28d) for every day of the calendar.

    A window sees one bucket: a row per day from its first one to the last day
    of all, days without its users as NULL.
    """
    end = bitmaps.agg(F.max("day").alias("d")).scalar()
    own = bitmaps.groupBy("bucket").agg(F.min("day").alias("first"))
    grid = own.select("bucket", F.explode(X.days_between(F.col("first"), end)).alias("day"))
    filled = grid.join(bitmaps, ["bucket", "day"], "left")
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("bucket").orderBy(number)
    counts = filled.select("day", *[
        F.coalesce(F.bitmap_count(F.bitmap_or_agg("users").over(w.rangeBetween(1 - n, 0))), F.lit(0)).alias(f"active_{n}d")
        for n in spans
    ])
    return counts.groupBy("day").agg(*[F.sum(f"active_{n}d").alias(f"active_{n}d") for n in spans])

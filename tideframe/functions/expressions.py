"""Small column expressions, all built-in and JVM-side."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A class is reached when the rating is above its bound.
CLASS_BOUNDS = [("star", 8), ("good", 7), ("average", 6)]
LOWEST_CLASS = "bad"

# States of an entity.
NEW = "New"
CONTINUED = "Continued Playing"
RETURNED = "Returned from retirement"
RETIRED = "Retired"
STAYED_RETIRED = "Stayed Retired"
YEARLY_ABSENCE_DAYS = 365

# Width of a date list in bits; the snapshot day is the leftmost bit.
DATELIST_BITS = 32


def quality_class(rating: Column) -> Column:
    """Class of a rating; bounds are exclusive, no rating is the lowest class."""
    reached = [F.when(rating > bound, F.lit(name)) for name, bound in CLASS_BOUNDS]
    return F.coalesce(*reached, F.lit(LOWEST_CLASS))


def day(ts: Column | str) -> Column:
    return F.to_date(ts)


def month_start(d: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(d, "MM")


def days_between(first: Column, last: Column) -> Column:
    """One array element per day, both ends included."""
    return F.sequence(first, last, F.expr("interval 1 day"))


def as_date(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.to_date(F.lit(str(value)))


def on_day(ts: str, d: Column) -> Column:
    """Times within day ``d``, as a range that reaches the scan."""
    return (F.col(ts) >= d) & (F.col(ts) < F.date_add(d, 1))


def up_to(df: DataFrame, ts: str, as_of: date | str | Column | None) -> DataFrame:
    """Rows up to the end of day ``as_of``; all rows when it is not given."""
    if as_of is None or isinstance(as_of, Column):
        return df
    return df.filter(F.col(ts) < F.date_add(as_date(as_of), 1))


def latest(df: DataFrame, d: Column) -> Column:
    """The last day in ``df`` as a scalar subquery: one value, one narrow scan."""
    return df.agg(F.max(d).alias("latest")).scalar()


def day_bit(snapshot: Column, d: Column) -> Column:
    """Bit of day ``d`` in the date list of ``snapshot``; 0 outside 32 days."""
    age = F.datediff(snapshot, d)
    top = DATELIST_BITS - 1
    # shiftleft takes the number of bits from a column only in SQL form.
    shifted = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(top) - age)
    return F.when(age.between(0, top), shifted).otherwise(F.lit(0).cast("bigint"))


def list_bits(dates: Column, snapshot: Column) -> Column:
    """Date list (array) to the 32-day number, for stored snapshots."""
    return F.aggregate(
        F.coalesce(dates, F.array().cast("array<date>")),
        F.lit(0).cast("bigint"),
        lambda acc, d: acc.bitwiseOR(day_bit(snapshot, d)),
    )


def bit_string(bits: Column) -> Column:
    """The number as 32 characters '0'/'1'."""
    return F.lpad(F.bin(bits), DATELIST_BITS, "0")


def recent_days_mask(n: int) -> int:
    """Mask of the snapshot day and the n-1 days before it."""
    return ((1 << n) - 1) << (DATELIST_BITS - n)


def active_days(bits: Column, n: int) -> Column:
    """How many of the last ``n`` days are set."""
    return F.bit_count(bits.bitwiseAND(F.lit(recent_days_mask(n)).cast("bigint")))

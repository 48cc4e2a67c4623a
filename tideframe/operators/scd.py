"""Type-2 slowly changing dimensions with closed intervals of years.

Snapshots have one row per key and period (checks.unique_key_violations), so a
key's rows are bounded by the number of periods.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideframe.operators.guards import require_previous

#: The period a stored history is valid for.
STAMP = "current_year"
KEY = "actorid"
ATTRIBUTES = ["quality_class", "is_active"]


def _same(left: str, right: str, attributes: list[str]) -> Column:
    """All attributes equal, NULL counting as a value."""
    return reduce(
        lambda a, b: a & b,
        (F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in attributes),
    )


def scd2_backfill(
    snapshots: DataFrame,
    key: str = KEY,
    attributes: list[str] = ATTRIBUTES,
    period: str = "current_year",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """History as of the last snapshot: one row per unbroken streak.

    A streak ends when an attribute changes or a period is missing.  Both
    windows and the final grouping share one shuffle and one sort by key.
    Columns in ``carry`` (a name, say) go along without being compared.
    """
    w = Window.partitionBy(key).orderBy(period)
    now = F.struct(*attributes)
    continues = F.lag(now).over(w).eqNullSafe(now) & (
        F.lag(period).over(w) == F.col(period) - 1
    )
    return (
        snapshots.select(key, *attributes, *carry, period)
        .withColumn("starts", F.when(continues, 0).otherwise(1))
        .withColumn("streak", F.sum("starts").over(w))
        .groupBy(key, "streak", *attributes)
        .agg(
            *[F.max(c).alias(c) for c in carry],
            F.min(period).alias("start_date"), F.max(period).alias("end_date"),
        )
        .select(key, *carry, *attributes, "start_date", "end_date")
    )


def stamp(history: DataFrame, period: int | Column) -> DataFrame:
    """Marks the period a history is valid for."""
    return history.withColumn(STAMP, F.lit(period))


def as_of_before(history: DataFrame, t: int | Column) -> DataFrame:
    """The history as of t-1, also when it already went through ``t`` or later.

    Of a stamped table the rows stamped t-1 are taken or, on a rerun of a table
    that holds only ``t``, those.  Intervals that begin at ``t`` or later are
    undone, and those that reach further end at t-1 again.
    """
    before = F.lit(t) - 1
    if STAMP in history.columns:
        at = F.col(STAMP)
        chosen = history.agg(
            F.coalesce(F.max(F.when(at == before, at)), F.max(F.when(at == F.lit(t), at))).alias("s")
        ).scalar()
        history = history.filter(at == chosen).drop(STAMP)
    return history.filter(F.col("start_date") <= before).withColumn(
        "end_date", F.least("end_date", before)
    )


def _compare(
    history: DataFrame, snapshot: DataFrame, t: int | Column, key: str,
    attributes: list[str], period: str,
) -> DataFrame:
    """Open intervals of t-1 beside the rows of snapshot t, one per key."""
    old = history.filter(F.col("end_date") == F.lit(t) - 1).select(
        key,
        *[F.col(c).alias(f"old_{c}") for c in attributes],
        F.col("start_date").alias("old_start"),
        F.col("end_date").alias("old_end"),
    )
    new = snapshot.filter(F.col(period) == F.lit(t)).select(
        key, *[F.col(c).alias(f"new_{c}") for c in attributes],
        F.col(period).alias("now"),
    )
    return old.join(new, key, "full_outer")


def _interval(prefix: str, attributes: list[str], start: Column, end: Column) -> Column:
    return F.struct(
        *[F.col(f"{prefix}{c}").alias(c) for c in attributes],
        start.alias("start_date"),
        end.alias("end_date"),
    )


def scd2_incremental(
    history: DataFrame,
    snapshot: DataFrame,
    t: int | Column,
    key: str = KEY,
    attributes: list[str] = ATTRIBUTES,
    period: str = "current_year",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """History as of ``t`` from the history as of ``t - 1`` and snapshot ``t``.

    Intervals already closed pass through without a shuffle.  One full outer
    join finds the unchanged, changed, new and absent keys; a changed key
    becomes two rows.  Running the step again gives the same rows; a stamped
    history that stops before t-1 is refused.
    """
    stored, history = history, as_of_before(history, t)
    values = [*carry, *attributes]
    both = _compare(history, snapshot, t, key, values, period)
    start, end, now = F.col("old_start"), F.col("old_end"), F.col("now")
    kept = _interval("old_", values, start, end)
    opened = _interval("new_", values, now, now)
    rows = (
        F.when(now.isNull(), F.array(kept))
        .when(start.isNull(), F.array(opened))
        .when(_same("old_", "new_", attributes), F.array(_interval("new_", values, start, now)))
        .otherwise(F.array(kept, opened))
    )
    current = both.select(key, F.inline(rows))
    closed = history.filter(F.col("end_date") < F.lit(t) - 1).select(*current.columns)
    result = stamp(closed.unionByName(current), t)
    if STAMP in stored.columns:
        result = require_previous(result, stored, STAMP, F.lit(t) - 1, F.lit(t))
    return result


def scd2_expand_changed(
    history: DataFrame,
    snapshot: DataFrame,
    t: int | Column,
    key: str = KEY,
    attributes: list[str] = ATTRIBUTES,
    period: str = "current_year",
) -> DataFrame:
    """Only the changed keys: the closed and the opened interval of each."""
    both = _compare(as_of_before(history, t), snapshot, t, key, attributes, period)
    now = F.col("now")
    changed = both.filter(
        now.isNotNull()
        & F.col("old_start").isNotNull()
        & ~_same("old_", "new_", attributes)
    )
    return changed.select(
        key,
        F.inline(
            F.array(
                _interval("old_", attributes, F.col("old_start"), F.col("old_end")),
                _interval("new_", attributes, now, now),
            )
        ),
    )


def scd2_splice(
    history: DataFrame,
    corrected: DataFrame,
    t: int | Column,
    key: str = KEY,
    attributes: list[str] = ATTRIBUTES,
    period: str = "current_year",
    carry: tuple[str, ...] = (),
    partial: bool = False,
) -> DataFrame:
    """``history`` with the snapshot of a past period ``t`` replaced.

    Intervals that hold ``t`` are split around it, the corrected rows take its
    place, and neighbours that now agree are joined again: what the backfill
    gives over the corrected snapshots.  Keys absent from the corrected
    snapshot lose the period; with ``partial`` only the keys that it holds are
    changed.

    Intervals that neither hold nor touch ``t`` pass through without a shuffle.
    The others, at most three per key, and the corrected rows meet in one
    shuffle by key, which the windows and the grouping share.  ``history`` is as
    of one period, not before ``t``, or carries one stamp, which stays.  Doing
    it again changes nothing.
    """
    at, values = F.lit(t), [*carry, *attributes]
    columns = [key, *values, "start_date", "end_date"]
    stamped = [STAMP] if STAMP in history.columns else []
    history = history.select(*columns, *stamped)
    near = (F.col("start_date") <= at + 1) & (F.col("end_date") >= at - 1)
    far = history.filter(~near)
    touching = history.filter(near).withColumn("is_new", F.lit(False))
    new = corrected.filter(F.col(period) == at).select(
        key, *values, F.col(period).alias("start_date"), F.col(period).alias("end_date"),
        *[F.lit(None).cast(history.schema[STAMP].dataType).alias(STAMP) for _ in stamped], F.lit(True).alias("is_new"),
    )
    of_key = Window.partitionBy(key)
    both = touching.unionByName(new)
    replaced = ~F.col("is_new")
    if partial:
        both = both.withColumn("is_changed", F.max("is_new").over(of_key))
        replaced = replaced & F.col("is_changed")
    whole = F.struct("start_date", "end_date")
    around = F.filter(
        F.array(
            F.struct(F.col("start_date"), F.least("end_date", at - 1).alias("end_date")),
            F.struct(F.greatest("start_date", at + 1).alias("start_date"), F.col("end_date")),
        ),
        lambda x: x["start_date"] <= x["end_date"],
    )
    parts = both.select(
        key, *values, *stamped, F.inline(F.when(replaced, around).otherwise(F.array(whole))))
    w = of_key.orderBy("start_date")
    now = F.struct(*attributes)
    continues = F.lag(now).over(w).eqNullSafe(now) & (F.lag("end_date").over(w) == F.col("start_date") - 1)
    joined = (
        parts.withColumn("starts", F.when(continues, 0).otherwise(1))
        .withColumn("streak", F.sum("starts").over(w))
        .groupBy(key, "streak", *attributes)
        .agg(
            *[F.max(c).alias(c) for c in [*carry, *stamped]],
            F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        )
        .select(*columns, *stamped)
    )
    if stamped:  # an interval of corrected rows alone has no stamp yet
        one = history.agg(F.max(STAMP).alias("s")).scalar()
        joined = joined.withColumn(STAMP, F.coalesce(STAMP, one))
    return far.unionByName(joined)


def scd2_group_summary(
    snapshots: DataFrame,
    key: str = KEY,
    attributes: list[str] = ATTRIBUTES,
    period: str = "current_year",
) -> DataFrame:
    """First and last period of each attribute combination, streaks ignored."""
    return snapshots.groupBy(key, *attributes).agg(
        F.min(period).alias("start_date"), F.max(period).alias("end_date")
    )

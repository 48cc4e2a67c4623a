"""Running totals over long ordered sequences, without one task per sequence.

A window over a key sorts all rows of the key in one task.  Here the order is
cut into levels (day, then range of ids): totals per level are small, their
prefix sums are windows over few rows, and only the leaves, whose size is
bounded, hold rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ids per leaf: with distinct ids a leaf has at most this many rows.
LEAF_IDS = 1_000_000

# Rows per block of a rolling frame.
BLOCK_ROWS = 100_000


def id_range(id_col: str) -> Column:
    """Order-preserving bucket of a numeric id."""
    return F.col(id_col) - F.pmod(F.col(id_col), F.lit(LEAF_IDS))


def _before(
    totals: DataFrame, keys: list[str], levels: list[str], sums: list[str]
) -> DataFrame:
    """before_<s> per leaf: everything of the key that precedes it."""
    outer = keys + levels[:-1]
    w = (
        Window.partitionBy(*outer)
        .orderBy(levels[-1])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("bigint")
    within = totals.select(
        *outer, levels[-1],
        *[F.coalesce(F.sum(s).over(w), zero).alias(f"before_{s}") for s in sums],
    )
    if len(levels) == 1:
        return within
    upper = totals.groupBy(*outer).agg(*[F.sum(s).alias(s) for s in sums])
    base = _before(upper, keys, levels[:-1], sums).select(
        *outer, *[F.col(f"before_{s}").alias(f"base_{s}") for s in sums]
    )
    return within.join(base, outer).select(
        *outer, levels[-1],
        *[(F.col(f"before_{s}") + F.col(f"base_{s}")).alias(f"before_{s}") for s in sums],
    )


def running_totals(
    rows: DataFrame,
    keys: list[str],
    levels: list[str],
    order: str,
    sums: list[str],
) -> DataFrame:
    """Adds run_<s>: the sum of s over the key's rows up to and with this one.

    (levels, order) is a total order within a key, each level being monotone in
    it.  ``sums`` are bigint columns.  Rows without a key or a place in the
    order are dropped.

    Rows are shuffled by leaf once.  Totals and in-leaf sums both read that
    shuffle: each names the order column, so that they ask for the same columns
    and Spark reuses the exchange instead of computing ``rows`` again.
    """
    leaf = keys + levels
    placed = rows
    for c in [*leaf, order]:
        # One filter per column, as the join below would infer them: the plans
        # of both readers then stay equal down to the scan.
        placed = placed.filter(F.col(c).isNotNull())
    placed = placed.repartition(*[F.col(c) for c in leaf])
    counted = {s: F.when(F.col(order).isNotNull(), F.col(s)) for s in sums}
    totals = placed.groupBy(*leaf).agg(*[F.sum(c).alias(s) for s, c in counted.items()])
    w = (
        Window.partitionBy(*leaf)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inner = placed.withColumns({f"in_{s}": F.sum(c).over(w) for s, c in counted.items()})
    return inner.join(_before(totals, keys, levels, sums), leaf).select(
        *rows.columns,
        *[(F.col(f"in_{s}") + F.col(f"before_{s}")).alias(f"run_{s}") for s in sums],
    )


def rolling_sum(
    rows: DataFrame,
    keys: list[str],
    position: str,
    running: str,
    width: int,
    alias: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Sum over the last ``width`` rows: the running total less the one before.

    ``position`` numbers a key's rows 1, 2, ...  Rows are cut into blocks of
    equal length and the last ``width`` rows of a block are copied to the next
    one, so that each row finds the total it needs within its block.
    """
    if block_rows < width:
        raise ValueError("a block must hold at least one frame")
    at = F.col(position) - 1
    in_block = F.pmod(at, F.lit(block_rows))
    block = ((at - in_block) / block_rows).cast("bigint")
    copies = F.when(in_block >= block_rows - width, F.array(block, block + 1)).otherwise(
        F.array(block)
    )
    w = Window.partitionBy(*keys, "block").orderBy(position)
    earlier = F.coalesce(F.lag(running, width).over(w), F.lit(0).cast("bigint"))
    return (
        rows.withColumn("home", block)
        .withColumn("block", F.explode(copies))
        .withColumn(alias, F.col(running) - earlier)
        .filter(F.col("block") == F.col("home"))
        .drop("block", "home")
    )

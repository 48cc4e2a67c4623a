"""Join helpers: size-checked broadcast and null-safe equality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side may hold at most this many rows and bytes of text form.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast hint only after measuring; beyond the bounds no hint is given.

    Measuring stops at ``max_rows + 1`` rows.  A larger side is left to a
    shuffled join, which AQE splits when a key is hot.
    """
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    n, n_bytes = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), size.alias("bytes"))
        .first()
    )
    return F.broadcast(df) if n <= max_rows and n_bytes <= max_bytes else df


def null_safe(pairs: dict[str, str]) -> Column:
    """left <=> right for each pair of column names: NULL meets NULL."""
    return reduce(
        lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(v)) for k, v in pairs.items())
    )


#: Items a heavy-hitter sketch keeps; its counts are off by a share of about 4 / this.
TRACKED = 4096


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """Values of ``key`` that hold at least about ``share`` of the rows, at most 1 / share many.

    One pass with a mergeable frequent-items sketch; no rows are shuffled.  NULL
    is none of them.  ``share`` has to be well above the sketch's error.
    """
    if not 8 / TRACKED <= share <= 1:
        raise ValueError(f"a share between {8 / TRACKED} and 1 is needed")
    found, n = df.agg(
        F.expr(f"approx_top_k({key}, {int(1 / share)}, {TRACKED})"), F.count(F.lit(1))
    ).first()
    return [x["item"] for x in found or [] if x["item"] is not None and x["count"] >= share * n]


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """Inner join of few hot keys: rows of ``large`` are dealt to ``salts`` parts of
    their key, rows of ``small`` are in each part.

    The deal is a hash of the row, so a recomputed task deals alike; rows that
    are equal in all columns are told apart by their place in their partition.
    """
    dealt = F.pmod(F.xxhash64(*large.columns, F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    left = large.withColumn("_salt", dealt)
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"]).drop("_salt")

"""State steps that refuse to lose state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_previous(
    result: DataFrame, state: DataFrame, column: str, before: Column, also: Column | None = None
) -> DataFrame:
    """``result``, or an error where ``state`` has rows but none of period ``before``
    (nor of ``also``).

    An empty state is the first run.  Only the period column of the state is
    read; the check adds no row and leaves the layout of ``result`` alone.
    """
    fits = F.col(column) == before
    if also is not None:
        fits = fits | (F.col(column) == also)
    seen = state.agg(F.count(F.lit(1)).alias("n"), F.count_if(fits).alias("fitting"))
    message = F.concat(F.lit("the state has no rows of "), before.cast("string"))
    skipped = F.when(
        (F.col("n") > 0) & (F.col("fitting") == 0), F.raise_error(message).cast("boolean")
    ).otherwise(F.lit(False))
    nothing = seen.filter(skipped).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema]
    )
    return result.unionByName(nothing)

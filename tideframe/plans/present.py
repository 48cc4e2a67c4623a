"""Result form of the registered queries.

Engines return dates, timestamps and arrays as different client types.  The
operators keep those types; only here, at the very end, are they written as
text, so that results can be compared across engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _text(name: str, t: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(t, T.DateType):
        return c.cast("string").alias(name)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, TIME_PATTERN).alias(name)
    if isinstance(t, T.DecimalType):
        return c.cast("double").alias(name)
    if isinstance(t, T.ArrayType) and not isinstance(t.elementType, T.StructType):
        return F.array_join(c.cast("array<string>"), ",").alias(name)
    return c


def flat(df: DataFrame) -> DataFrame:
    return df.select(*[_text(f.name, f.dataType) for f in df.schema])


def films_text(films: Column) -> Column:
    """filmid:votes:rating of each film, the rating with seven decimals."""
    return F.array_join(
        F.transform(
            films,
            lambda f: F.concat_ws(
                ":",
                f["filmid"],
                f["votes"].cast("string"),
                f["rating"].cast("decimal(12,7)").cast("string"),
            ),
        ),
        ",",
    )

"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson-distributed number of times whose mean is
the repetition rate of its source.  The draw inverts the distribution at a
number hashed from seed and document, so it is the same on every run and needs
no state.  Copies are then dealt to partitions and ordered by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions.joins import broadcast_if_small
from tideframe.llm.common import columns_of, free_names, written

#: Weights follow the sources' sizes to this power, unless given.
EXPONENT = 0.7
SEED = "mix-1"
#: The columns that a mix adds.
ADDED = ("mix_rate", "mix_copies", "mix_copy", "mix_order")
#: Hex digits of a hash that make a number: 52 bits, exact in a double.
DIGITS = 13


def unit(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of ``key``."""
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("long") / F.lit(
        float(16**DIGITS)
    )


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... as an array, far into the tail."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    zero = F.struct(
        (-rate).alias("logp"), F.exp(-rate).alias("sum"),
        F.array(F.exp(-rate)).alias("cdf"),
    )

    def step(s: Column, k: Column) -> Column:
        logp = s["logp"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(
            logp.alias("logp"), (s["sum"] + F.exp(logp)).alias("sum"),
            F.array_append(s["cdf"], s["sum"] + F.exp(logp)).alias("cdf"),
        )

    return F.when(
        rate > 0, F.aggregate(F.sequence(F.lit(1), last), zero, step, lambda s: s["cdf"])
    ).otherwise(F.array(F.lit(1.0)))


def source_rates(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    exponent: float = EXPONENT,
    epochs: float = 1.0,
) -> DataFrame:
    """source, size, rate.  The mix is to hold ``epochs`` times all characters.

    A document's size is its characters and one for its end, so no source has
    size 0.  Given ``weights`` need not add up to 1; a source they do not name
    gets none.
    """
    size = F.length(F.coalesce("text", F.lit(""))) + 1
    sizes = written(
        docs.groupBy("source").agg(F.sum(size).cast("double").alias("size")), "mix-sizes"
    )
    if weights is None:
        weight = F.pow("size", F.lit(exponent))
    else:
        weight = F.lit(0.0)
        for source, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), float(w)).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    whole = sizes.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    if whole.size is not None and not whole.weight:
        raise ValueError("no source has a weight")
    share = F.col("weight") / F.lit(whole.weight or 1.0)
    return sizes.select(
        "source", "size",
        (share * F.lit(float(epochs) * (whole.size or 0.0)) / F.col("size")).alias("rate"),
    )


def poisson_mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    exponent: float = EXPONENT,
    epochs: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """The mixed corpus: all columns of ``docs`` and ``mix_rate``, ``mix_copies``,
    ``mix_copy`` (1 ...), ``mix_order``, in random order.

    Rows are drawn by doc_id; a row without one by its text.  Rows that repeat
    a doc_id share its draw.  A NULL source is a source of its own; NULL or
    empty text counts as size 1.  Columns of ``docs`` that have one of the four
    names are replaced.  An empty table stays empty.

    Rates are one row per source.  They are broadcast when counted and
    measured to be small, otherwise joined by source, which AQE splits.
    """
    return _replicated(docs.drop(*ADDED), ADDED, weights, exponent, epochs, seed)


def _replicated(
    docs: DataFrame,
    added: tuple[str, ...] | list[str],
    weights: dict[str | None, float] | None = None,
    exponent: float = EXPONENT,
    epochs: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """The mix, with its own columns named ``added``."""
    rate, copies, copy, order = added
    source, cdf, draw = free_names(docs, "_mix_source", "_mix_cdf", "_mix_draw")
    rates = broadcast_if_small(
        source_rates(docs.select("source", "text"), weights, exponent, epochs).select(
            F.col("source").alias(source), F.col("rate").alias(rate),
            poisson_cdf(F.col("rate")).alias(cdf),
        )
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    place = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), key, F.col(copy).cast("string")))
    return (
        docs.join(rates, F.col("source").eqNullSafe(F.col(source)))
        .withColumn(draw, unit(F.concat_ws("|", F.lit(seed), key)))
        .withColumn(copies, F.size(F.filter(cdf, lambda c: c <= F.col(draw))))
        .filter(F.col(copies) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .withColumn(order, place)
        .drop(source, cdf, draw)
        .repartition(order)
        .sortWithinPartitions(order)
    )


def mix_stage(docs: DataFrame) -> DataFrame:
    """The mixed corpus with the columns of ``docs`` as they are, also those named like a mix's own.

    NULLs, repeated rows and empty tables are treated as by ``poisson_mix``.
    """
    return _replicated(docs, free_names(docs, *ADDED)).select(*columns_of(docs))

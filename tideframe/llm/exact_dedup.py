"""Exact deduplication that no hot group of copies can slow down.

Copies are combined three times: within each map task, within each of a few
salts of a digest group, and over the salts.  The full text is part of the key
every time, so equal digests alone never merge two texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def groups_of_copies(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per different text: digest, check, keep_id, group_size.

    ``check`` is a second digest; the pair names the text where rows are
    matched with their group afterwards.
    """
    body = F.coalesce("text", F.lit(""))
    return (
        docs.select(
            "doc_id", body.alias("body"), digest(body).alias("digest"),
            F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
        )
        .groupBy("digest", "body", "salt")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .groupBy("digest", "body")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .select("digest", F.xxhash64("body").alias("check"), "keep_id", "group_size")
    )


def exact_dedup(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, digest.

    Of equal texts the row with the largest doc_id stays; NULL text is empty
    text.  Rows that repeat a doc_id and text count in group_size, and one of
    them can stay.  A NULL doc_id is smaller than any other; a group of such
    rows alone has a NULL keep_id and keeps one.  Other columns are not read.
    An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    body = F.coalesce("text", F.lit(""))
    members = (
        docs.select("doc_id", digest(body).alias("digest"), F.xxhash64(body).alias("check"))
        .groupBy("digest", "check", "doc_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        members.join(groups_of_copies(docs, salts, digest), ["digest", "check"])
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            "digest",
        )
    )

"""Rows that every operator has to stand."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, kind: str = "w") -> str:
    r = random.Random(seed)
    return " ".join(f"{kind}{r.randrange(100_000)}x" for _ in range(n))


def docs(spark, rows, schema=DOCS):
    """Documents from (doc_id, text) or full rows, in several partitions."""
    full = [(*r, "en", "src", None if r[1] is None else len(r[1])) if len(r) == 2 else r for r in rows]
    return spark.createDataFrame(full, schema).repartition(3)


def odd_rows():
    """NULLs everywhere, empty and very long texts, ties, repeated rows."""
    long = words(1, 60_000)
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (None, "a text without a number", None, None, None),
        (None, None, None, None, None), (3, long, "en", "a", len(long)), (4, "same text here", "en", "a", 14),
        (4, "same text here", "en", "a", 14), (5, "same text here", "de", "b", 14), (5, "other text there", "de", "b", 16),
        (6, " \n\t ", "fr", "c", 4), (7, "!!! ### 12", "fr", "c", 10),
    ]


def clashing(df):
    """The table with columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = ["kept", "score", "rate", "mix_copy", "mix_order", "root", "name", "key", "hub", "place", "n", "spans",
             "items", "line", "leaf", "digest", "check", "salt", "path", "host", "x", "m", "part", "start", "held_out",
             "_kept", "_kept_", "_q_kept", "_leak_hits", "_leak_words", "_Leak_words_", "_mix_source", "_mix_draw", "_mix_cdf",
             "mix_rate", "Mix_Copies", "_near_place", "raw", "blank"]
    return df.withColumns({n: F.lit("clash") for n in names})

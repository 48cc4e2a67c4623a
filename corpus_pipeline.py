"""From raw documents to token files, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideframe.llm.common import session, table, written
from tideframe.llm.cotraining import drop_poor
from tideframe.llm.decontaminate import remove_leaks
from tideframe.llm.order_minhash import drop_near_duplicates
from tideframe.llm.poisson_mix import mix_stage
from tideframe.llm.token_files import default_tokenizer, read_tokens, write_tokens
from tideframe.session import work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return drop_poor(docs, table(session(spark), sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    session(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark go."""
    return remove_leaks(docs, table(session(spark), sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in random order."""
    session(spark)
    return mix_stage(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix in the random order it was written in; what is read back from them, with the ids."""
    out = work_folder(session(spark), "pipeline-tokens")
    write_tokens(docs, out, default_tokenizer(), as_they_come=True)
    return read_tokens(spark, out, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("source mixing", mixing),
    ("token files", token_output),
]

#: No SQL expresses a trained classifier or a tokenizer; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(session(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs

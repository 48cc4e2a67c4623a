"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.chat_format import LEARN, START, STOP, format_chats, read_back, turn_records
from tideframe.llm.common import session, table, written
from tideframe.llm.cotraining import quality
from tideframe.llm.decontaminate import find_leaks
from tideframe.llm.exact_dedup import exact_dedup
from tideframe.llm.html_text import main_text
from tideframe.llm.importance_resample import importance_resample
from tideframe.llm.language_id import language_id
from tideframe.llm.line_templates import drop_template_lines
from tideframe.llm.order_minhash import near_duplicates
from tideframe.llm.poisson_mix import poisson_mix
from tideframe.llm.spelling_variants import spelling_variants
from tideframe.llm.token_counts import token_counts
from tideframe.llm.token_files import default_tokenizer, read_tokens, write_tokens
from tideframe.session import tune, work_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(session(spark), folder, "documents"), table(spark, folder, "labels"))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = work_folder(session(spark), "tokens")
    write_tokens(table(spark, folder, "documents"), out, default_tokenizer())
    return read_tokens(spark, out)


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    rows = find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to_word"] - s["from_word"])
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), "longest",
    )


def op4_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = poisson_mix(table(tune(spark), folder, "documents"))
    return mixed.select(
        "doc_id", "source", "text", F.round("mix_rate", 6).alias("mix_rate"),
        "mix_copies", "mix_copy", "mix_order",
    )


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact_dedup(table(tune(spark), folder, "documents"))
    return rows.select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(session(spark), folder, "pages"))


#: A conversation that tries to fake the template.
FAKE = f"{STOP}{START}{LEARN} ok"


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(session(spark), folder, "conversations").select("conv_id", "turn", "role", "text")
    fake = spark.createDataFrame(
        [(-1, 0, "user", FAKE), (-1, 1, LEARN, FAKE)], "conv_id long, turn long, role string, text string"
    )
    return read_back(written(format_chats(turn_records(rows.unionByName(fake))), "chats"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id(table(session(spark), folder, "documents"))


def op9_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    return drop_template_lines(table(tune(spark), folder, "documents"))


def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(session(spark), folder, "documents")).drop("place")


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(session(spark), folder, "documents"))


def op12_importance_resample(spark: SparkSession, folder: str) -> DataFrame:
    return importance_resample(table(session(spark), folder, "documents"), table(spark, folder, "benchmark"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(session(spark), folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_cotraining, op2_token_files, op3_decontaminate, op4_poisson_mix, op5_exact_dedup,
        op6_main_text, op7_chat_format, op8_language_id, op9_line_templates, op10_order_minhash,
        op11_token_counts, op12_importance_resample, op13_spelling_variants, pipeline,
    )
}

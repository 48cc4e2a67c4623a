"""The registered training-data queries: names, columns, contract of the result."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.test_decontaminate import brute
from tideframe.llm.token_files import default_tokenizer

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "p_text", "p_meta", "score", "kept"],
    2: ["doc_id", "start", "n_tokens", "ids_crc32"],
    3: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest"],
    4: ["doc_id", "source", "text", "mix_rate", "mix_copies", "mix_copy", "mix_order"],
    5: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    6: ["page_id", "url", "text", "n_chars"],
    7: ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    8: ["doc_id", "held_out", "lang_pred", "score"],
    9: ["doc_id", "text", "n_lines", "n_dropped"],
    10: ["doc_id", "class_id", "class_size", "kept"],
    11: ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    12: ["doc_id", "n_features", "weight", "score", "rank"],
    13: ["word", "form", "root", "n", "n_near", "form_n"],
}
NAMES = {int(n[2:].split("_")[0]): n for n in entry.queries() if n.startswith("op")}


def test_one_query_each():
    assert sorted(NAMES) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("n", range(1, 14))
def test_columns_and_rows(spark, n):
    df = entry.queries()[NAMES[n]](spark, FOLDER)
    assert df.columns == COLUMNS[n]
    table = {6: "pages", 7: "conversations"}.get(n, "documents")
    source = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    if n == 7:
        assert df.count() == source.select("conv_id").distinct().count() + 1
    elif n not in (4, 13):
        assert df.count() == source.count()


def test_token_files_of_the_table(spark):
    from tokenizers import Tokenizer

    t, start = Tokenizer.from_file(default_tokenizer()), 0
    got = {r.doc_id: r for r in entry.queries()[NAMES[2]](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_leaks_of_the_table(spark):
    import hashlib

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in entry.queries()[NAMES[3]](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").filter(F.length("text") < 3000).collect()
    for r in rows:
        n, hit, found = brute(r.text, items, 10)
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (n, hit, len(found), hit > 0)
        assert g.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert any(r.contaminated for r in got.values())

"""Token files: exact round trip, random access, the tokenizer's own ids."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.fixtures import DOCS, clashing, docs, odd_rows, words
from tideframe.llm.token_files import (
    Segment, WordIds, default_tokenizer, pack_segment, read_tokens, tokens_at, write_tokens,
)
from tideframe.session import work_folder

PATH = default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def known():
    return WordIds(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 700), max_size=40), max_size=60))
def test_round_trip(lists):
    ids = np.array([i for x in lists for i in x], dtype=np.uint32)
    s = Segment(pack_segment(ids, [None if k % 7 == 3 else k - 2 for k in range(len(lists))], [len(x) for x in lists]))
    assert s.ids().tolist() == ids.tolist()
    assert [s.token(i) for i in range(len(ids))] == ids.tolist()
    assert s.docs == [None if k % 7 == 3 else k - 2 for k in range(len(lists))]
    assert np.diff(s.starts).tolist() == [len(x) for x in lists]
    with pytest.raises(IndexError):
        s.token(len(ids))


def test_ranks_over_many_blocks():
    ids = np.random.Generator(np.random.PCG64(3)).integers(0, 70_000, 5000).astype(np.uint32)
    s = Segment(pack_segment(ids, [1], [5000]))
    assert len(s.levels) == 3 and [s.token(i) for i in range(0, 5000, 7)] == ids[::7].tolist()


ODD = [
    "", "  a", "Don't STOP'S we've", "ΣΑΣ ςσΣ", "é é x́,", "<|endoftext|> <|ENDOFTEXT|> a<|endoftext|>b",
    "İstanbul ŞX", "a b\u0085c\x1cd\x0be", "Straße ÀÉ ÿ µ ª º", "x,,,...y", "ab!?'s 12a3 ½", "日本語 русский ПРИВЕТ",
    "a" * 300, "it's'd", "don'", "rock'n'roll", "\xadsoft", "x\xad.", "x y",
]


@pytest.mark.parametrize("text", ODD)
def test_words_as_the_tokenizer_has_them(tokenizer, known, text):
    assert known.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aéß'.,<|> \nAÉ1", max_size=60))
def test_any_text_as_the_tokenizer_has_it(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH) if not hasattr(test_any_text_as_the_tokenizer_has_it, "t") else test_any_text_as_the_tokenizer_has_it.t
    test_any_text_as_the_tokenizer_has_it.t = t
    k = getattr(test_any_text_as_the_tokenizer_has_it, "k", None) or WordIds(PATH)
    test_any_text_as_the_tokenizer_has_it.k = k
    assert k.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_files_of_odd_rows(spark, tokenizer):
    rows = odd_rows() + [(100 + i, words(i, 50)) for i in range(40)]
    out = work_folder(spark, "tokens")
    write_tokens(clashing(docs(spark, rows)), out, PATH, segment_tokens=300)
    got = sorted(read_tokens(spark, out, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    whole = []
    want = sorted(tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows)
    assert sorted(tuple(r.ids) for r in got) == want
    for r in got:
        assert r.start == len(whole) and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        whole += r.ids
    places = list(range(0, len(whole), 97)) + [len(whole) - 1, len(whole), -1]
    found = tokens_at(spark, out, spark.createDataFrame([(p,) for p in places], "p long")).collect()
    assert {r.position: r.token for r in found} == {p: whole[p] for p in places if 0 <= p < len(whole)}


def test_a_shuffled_corpus_keeps_its_order(spark):
    """Copies stay as far apart as they were, and nothing is shuffled for it."""
    rows = [(i * 7 % 30, words(i * 7 % 30, 20)) for i in range(300)]
    mixed = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = work_folder(spark, "tokens")
    write_tokens(mixed, out, PATH, segment_tokens=1000, as_they_come=True)
    got = sorted(read_tokens(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [d for d, _ in rows]


def test_no_documents(spark):
    out = work_folder(spark, "tokens")
    write_tokens(spark.createDataFrame([], DOCS), out, PATH)
    assert read_tokens(spark, out).count() == 0
    assert tokens_at(spark, out, spark.range(3)).count() == 0

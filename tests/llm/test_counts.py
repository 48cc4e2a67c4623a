"""Token counts, importance resampling, spelling variants: against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.fixtures import DOCS, clashing, docs, odd_rows
from tideframe.llm import importance_resample as I
from tideframe.llm import spelling_variants as S
from tideframe.llm.common import LOWER, WORD, pieces
from tideframe.llm.queries import QUERIES
from tideframe.llm.token_counts import LengthTable, UnitSizes, count_tokens, token_counts
from tideframe.llm.token_files import default_tokenizer

FOLDER = "/root/testdata/sf0.001"
PATH = default_tokenizer()
ODD = list("abcXYZ 012 .,!'s't <|> \n\t\r  éÉßÄ÷× ²½ Σσς İı 中文 한 𝔸 ʼ’ª µ º _-") + [
    "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "'ll", "'re", "e\u0301", "\u0301", "\u0085", "\x00",
    "\x0b", "\x1c", "\u00a0", "\u200b", "word ", "thing ", "the ",
]


def odd_texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randrange(60))) for _ in range(n)]


def table_rows(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


# --- token counts ---------------------------------------------------------------


def sizes(texts):
    t = Tokenizer.from_file(PATH)
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


@pytest.mark.parametrize("known", [[], ["a", "the", "word", "thing", ".", ",", "é", "1", "s", "<|>"]])
def test_token_counts_equal_the_tokenizer(known):
    texts, memory = odd_texts(4000), UnitSizes(PATH)
    table = LengthTable({u.encode(): memory[u.encode()] for u in known})
    assert count_tokens([x.encode() for x in texts], table, memory).tolist() == sizes(texts)


def test_length_table_holds_what_it_was_given():
    given = {f"{i:x}".encode(): i % 50 for i in range(5000)}
    table = LengthTable({**given, b"": 1, b"too long for the table's keys": 7, b"zero\0": 2})
    assert (table.size > 0).sum() == len(given) and len(table.size) >= 2 * len(given)
    low, high = (np.array([int.from_bytes(u[a:b], "little") for u in [*given, b"absent"]], dtype=np.uint64)
                 for a, b in ((0, 8), (8, 16)))
    assert table.look(low, high).tolist() == [*given.values(), -1]


def test_pieces_join_to_the_text():
    for text in (b"", b"one", b"aa bb\ncc\tdd" * 9, b"x" * 50 + b" y", b" " * 30):
        cut = list(pieces(text, 8))
        assert b"".join(cut) == text and all(len(p) <= 8 or b" " not in p[:-1] for p in cut)


@pytest.mark.parametrize("sample", [1, 2000])
def test_token_counts_of_odd_rows(spark, sample):
    got = token_counts(clashing(docs(spark, odd_rows())), sample=sample, table_units=50)
    bodies = [r[1] or "" for r in odd_rows()]
    want = Counter(zip((r[0] for r in odd_rows()), (len(b.encode()) for b in bodies), sizes(bodies)))
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got.collect())


def test_token_counts_of_the_table(spark):
    rows = table_rows(spark)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in QUERIES["op11_token_counts"](spark, FOLDER).collect()}
    want = dict(zip((r[0] for r in rows), zip((len(r[1].encode()) for r in rows), sizes([r[1] for r in rows]))))
    assert got == want


def test_token_counts_shuffle_nothing(spark):
    p = token_counts(docs(spark, odd_rows()).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert p.count("MapInArrow") == 1 and "hashpartitioning" not in p


# --- importance resampling ------------------------------------------------------


def feature_sums(text):
    words = WORD.findall((text or "").translate(LOWER))
    return Counter(zlib.crc32(x.encode()) for x in words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def resampled(rows, target, share=25, min_words=20, buckets=10_000, seed=7):
    """Brute force: Counter of (doc_id, n_features, weight, score, rank)."""
    def total(texts):
        n = Counter()
        for t in texts:
            for h, k in feature_sums(t).items():
                n[h % buckets] += k
        return n

    have, want = total(t for _, t in rows), total(target)
    a, b = sum(have.values()), sum(want.values())
    gain = [floor(1000 * log((want[i] + 1) * (a + buckets) / ((have[i] + 1) * (b + buckets)))) for i in range(buckets)]
    out = []
    for doc, text in rows:
        f = feature_sums(text)
        n = sum(f.values())
        weight = sum(gain[h % buckets] * k for h, k in f.items()) // n if n else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, n, weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if (r[1] + 1) // 2 >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[: share * len(fit) // 100], 1):
        r[4] = i
    return Counter(map(tuple, out))


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 512, 1000, 65_536, 65_537, 150_001])
def test_long_checksums(n):
    data = random.Random(n).randbytes(n)
    assert I.long_checksum(np.frombuffer(data, dtype=np.uint8)) == zlib.crc32(data)


@pytest.mark.parametrize("limit", [1 << 20, 64, 7])
def test_features_of_any_text(limit):
    r = random.Random(4)
    texts = ["".join(r.choice("abcDEF  \n..1é中") for _ in range(r.choice([0, 1, 5, 50, 400]))) for _ in range(500)]
    texts += ["x" * 300 + " " + "y" * 200 + " " + "z" * 90, "é" * 130 + " a", "a " + "中" * 100, "w" * 70_000]
    got = [Counter() for _ in texts]
    for owner, sums in I.features([t.encode() for t in texts], limit):
        for i, h in zip(owner.tolist(), sums.tolist()):
            got[i][h] += 1
    assert got == [feature_sums(t) for t in texts]


def test_resampling_of_the_table(spark):
    target = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = resampled(table_rows(spark), target)
    assert found(QUERIES["op12_importance_resample"](spark, FOLDER)) == want
    assert sum(r[4] is not None for r in want) > 20


@pytest.mark.parametrize("min_words,share", [(0, 100), (3, 50)])
def test_resampling_of_odd_rows(spark, min_words, share):
    target = [(1, "same text"), (2, None), (3, "")]
    got = I.importance_resample(
        clashing(docs(spark, odd_rows())), clashing(docs(spark, target)), share, min_words, buckets=97)
    want = resampled([r[:2] for r in odd_rows()], [t for _, t in target], share, min_words, 97)
    # equal rows may change places
    assert Counter(r[:4] for r in found(got).elements()) == Counter(r[:4] for r in want.elements())
    assert sorted(r[4] for r in found(got).elements() if r[4]) == sorted(r[4] for r in want.elements() if r[4])


def test_resampling_draws_what_is_like_the_target(spark):
    rows = [(i, " ".join(f"{'law' if i % 4 == 0 else 'pop'}{k % 30}" for k in range(i, i + 40))) for i in range(400)]
    target = [(0, " ".join(f"law{k % 30}" for k in range(300)))]
    got = I.importance_resample(docs(spark, rows), docs(spark, target)).filter("rank is not null").collect()
    assert len(got) == 100 and sum(r.doc_id % 4 == 0 for r in got) > 60


# --- spelling variants ------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelled(rows, modulus=199, shortest=6, min_count=5, ratio=5):
    """Brute force: {word: (form, root, n, n_near, form_n)}."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: k for w, k in n.items() if k >= min_count and len(w) >= shortest}
    holes = defaultdict(set)
    for w in words:
        for x in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))]:
            holes[x].add(w)
    near = {w: {v for x in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))] for v in holes[x] if one_edit(v, w)}
            for w in words}
    form = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in form.items() if words[v] >= ratio * words[w]}
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None
    return out


def variants(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_of_the_table(spark):
    want = spelled(table_rows(spark))
    assert variants(QUERIES["op13_spelling_variants"](spark, FOLDER)) == want
    assert any(v[0] for v in want.values())


@pytest.mark.parametrize("seed", range(3))
def test_spelling_of_dense_words(spark, seed):
    """Few letters, so that words have many neighbours, repeated letters and long chains of forms."""
    r = random.Random(seed)
    words = ["".join(r.choice("abé") for _ in range(r.choice([3, 4, 5, 6, 9]))) for _ in range(600)]
    words += ["a" * k for k in range(3, 40)] + ["ab" * k + "c" * (k % 3) for k in range(2, 20)]
    rows = [(i, " ".join(r.choice(words).upper() if r.random() < 0.2 else r.choice(words) for _ in range(40))
             + " aaaa" * (i % 7)) for i in range(60)]
    got = S.spelling_variants(docs(spark, rows), modulus=3, shortest=4, min_count=1, ratio=2)
    want = spelled(rows, 3, 4, 1, 2)
    assert variants(got) == want and any(v[0] and v[1] != v[0] for v in want.values())


def test_spelling_of_long_words(spark):
    """Words of thousands of letters that part near their ends."""
    base = "".join(random.Random(1).choice("abcdefgh") for _ in range(3000))
    words = [base, base[:-5] + base[-4:], base[:2990] + "z" + base[2991:], base[:1500] + "q" + base[1500:], "y" + base[1:]]
    rows = [(i, " ".join([w] * (10 if w == base else 1))) for i, w in enumerate(words)]
    got = S.spelling_variants(docs(spark, rows), modulus=10**9, min_count=1)
    assert variants(got) == spelled(rows, 10**9, min_count=1)


def test_spelling_of_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    got = S.spelling_variants(clashing(docs(spark, odd_rows())), modulus=2, shortest=4, min_count=1, ratio=2)
    assert variants(got) == spelled(rows, 2, 4, 1, 2)
    with pytest.raises(ValueError):
        S.spelling_variants(docs(spark, odd_rows()), ratio=1)


def test_spelling_spares_the_crowded_root(spark):
    """No state is expanded above the middle of its word."""
    rows = [(0, " ".join(f"{a}{b}word{c}" for a in "abcd" for b in "abcd" for c in "xy"))]
    words = S.vocabulary(docs(spark, rows), 10**9, 6, 1).withColumn("id", F.monotonically_increasing_id())
    for r in S.branching_paths(words).collect():
        assert all(x.depth >= len(r.s) // 2 for x in r.nodes)


# --- empty tables -------------------------------------------------------------------


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    some = docs(spark, [(1, "a few words of a text"), (2, None)])
    assert token_counts(none).count() == 0
    assert S.spelling_variants(none).count() == 0
    assert I.importance_resample(none, some).count() == 0
    assert found(I.importance_resample(some, none, min_words=1, share=100)) == resampled(
        [(1, "a few words of a text"), (2, None)], [], 100, 1)

"""Quality classifier, near-duplicates, and the pipeline."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.fixtures import DOCS, clashing, docs, odd_rows, words
from tests.llm.test_decontaminate import brute
from tideframe.llm import cotraining as Q
from tideframe.llm import order_minhash as N
from tideframe.llm.common import WORD, LOWER, word_hashes
from tideframe.llm.queries import QUERIES

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"

# --- quality


def test_quality_of_held_out_labels(spark):
    d = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    learn = labels.filter("doc_id % 3 <> 0")
    got = {r.doc_id: r for r in Q.quality(d, learn).collect()}
    test = labels.filter("doc_id % 3 = 0").collect()
    assert len(got) == d.count()
    assert sum(got[r.doc_id].kept == bool(r.quality) for r in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got.values())


def test_views_teach_each_other(spark):
    """The metadata view knows nothing at first but what its few labels show."""
    r = random.Random(2)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(["SPAM!!"] * 30) if bad else words(i, 30, "ab")
        rows.append((i, text, "en", "farm" if bad else f"site{r.randrange(5)}", len(text)))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(40)], LABELS)
    d = docs(spark, rows)
    alone, together = Q.train(d, labels, rounds=0), Q.train(d, labels)
    farm, site = np.zeros((2, 1, Q.META_FEATURES), dtype=np.float32)
    farm[0, Q.meta_places("farm", "en", 209)] = 1
    site[0, Q.meta_places("site1", "en", 209)] = 1
    gap = [m.meta.weights @ (site - farm)[0] for m in (alone, together)]
    assert gap[1] > 0 and together.meta.probability(site) > together.meta.probability(farm)
    assert all(r.kept == (r.doc_id % 4 != 0) for r in Q.quality(d, labels).collect())


def test_quality_of_odd_rows(spark):
    d = clashing(docs(spark, odd_rows()))
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (None, 1, 0), (5, None, 0), (5, 1, 1), (7, 0, 0), (7, 0, 0)], LABELS)
    got = Q.quality(d, labels).collect()
    assert len(got) == len(odd_rows()) and not any(r.kept for r in got if r.doc_id in (1, 2, 6))
    for few in (labels.limit(0), labels.filter("quality = 1")):
        got = Q.quality(d, few).collect()
        assert {(r.score, r.kept) for r in got} == {(0.5, True), (0.0, False)}
    kept = Q.drop_poor(d, labels.limit(0))
    assert kept.columns == d.columns and kept.count() == sum(bool(r[1] and r[1].strip()) for r in odd_rows())
    none = spark.createDataFrame([], DOCS)
    assert Q.quality(none, labels).count() == 0
    assert Q.drop_poor(d, labels).columns == d.columns


def test_rows_of_one_labelled_document_are_sampled_once(spark):
    d = docs(spark, [(1, f"text number {i % 9}", "en", "s", 13) for i in range(500)] + [(2, "other", "en", "s", 5)])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], LABELS)
    x, m, y = Q.labelled(d, labels)
    assert len(x) == len(m) == 2 and sorted(y) == [0, 1]


# --- near-duplicates

def edited(text: str, seed: int, n: int) -> str:
    w, r = text.split(), random.Random(seed)
    for _ in range(n):
        k = r.randrange(len(w))
        w[k:k + 1] = r.choice([[], ["new"], [w[k], "more"]])
    return " ".join(w)


def shingles(text):
    return N.labelled_shingles(word_hashes((text or "").encode()))


def classes_of(rows):
    """Brute force: class of each text, from all pairs."""
    texts = sorted({t or "" for _, t, *_ in rows})
    s = {t: shingles(t) for t in texts}
    group = {t: {t} for t in texts}
    for i, a in enumerate(texts):
        for b in texts[i + 1:]:
            if N.similarity(s[a], s[b]) >= N.SIMILAR and group[a] is not group[b]:
                group[a] |= group[b]
                for t in group[b]:
                    group[t] = group[a]
    return group, s


def check(rows, got):
    group, s = classes_of(rows)
    out = Counter()
    seen: dict[int, list] = {}
    for d, t, *_ in rows:
        if len(s[t or ""]):
            seen.setdefault(id(group[t or ""]), []).append(d)
    for ids in seen.values():
        low = min((i for i in ids if i is not None), default=None)
        for d in ids:
            out[d, low, len(ids)] += 1
    for d, t, *_ in rows:
        if not len(s[t or ""]):
            out[d, d, 1] += 1
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == out
    assert sum(r.kept for r in got) == len(seen) + sum(not len(s[t or ""]) for _, t, *_ in rows)
    assert all(r.doc_id == r.class_id for r in got if r.kept)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(8)
    base = [words(k, r.choice([6, 9, 40, 150, 400])) for k in range(12)]
    passage = words(999, 60)
    rows = odd_rows()
    for k in range(90):
        t = r.choice(base)
        rows.append((200 + k, edited(t, k, r.choice([0, 1, 1, 2, len(t.split()) // 45, len(t.split()) // 8]))))
    rows += [(400 + k, words(k + 50, 30) + " " + passage + " " + words(k + 80, 30)) for k in range(12)]
    rows += [(500 + k, edited(base[3], 5, 1)) for k in range(30)]
    return rows


def test_near_duplicates_like_brute_force(spark, corpus):
    check(corpus, N.near_duplicates(clashing(docs(spark, corpus))).collect())


def test_chains_behind_hubs(spark):
    """Each version is near its neighbours only; all are one class."""
    text, rows = words(4, 120), []
    for k in range(25):
        rows.append((k, text))
        text = edited(text, k, 2)
    got = N.near_duplicates(docs(spark, rows)).collect()
    check(rows, got)


def test_pairs_within_a_family_of_strangers(spark):
    """Strangers at 0.74 all meet; the pairs at 0.83 among them are found, whoever is hub."""
    passage = words(70, 104)
    own = [words(1000 + k, 18).split() for k in range(600)]
    rows = [(k, " ".join([passage, *w])) for k, w in enumerate(own)]
    rows += [(1000 + k, " ".join([passage, *own[k][:7], words(3000 + k, 11)])) for k in range(0, 600, 20)]
    s = {d: shingles(t) for d, t in rows}
    assert 0.7 < N.similarity(s[0], s[1], 0.5) < 0.79 and N.similarity(s[0], s[1000]) > 0.82
    got = {r.doc_id: (r.class_id, r.class_size) for r in N.near_duplicates(docs(spark, rows)).collect()}
    assert got == {d: (d % 1000, 2 if d % 20 == 0 else 1) for d, _ in rows}


def test_prefixes_of_similar_pairs_meet():
    r = np.random.default_rng(3)
    for _ in range(300):
        n, cut = int(r.integers(1, 80)), r.random() * 0.25
        a = r.permutation(1000)[:n]
        b = np.concatenate([a[r.random(n) > cut], r.permutation(np.arange(1000, 2000))[:int(r.integers(0, 1 + n // 6))]])
        both = len(np.intersect1d(a, b))
        if both and both / (len(a) + len(b) - both) >= N.SIMILAR:
            x, y = sorted((a, b), key=len)
            assert set(np.sort(x)[:N.prefix_lengths(len(x), N.SIMILAR)[0]]) & set(np.sort(y)[:N.prefix_lengths(len(y), N.SIMILAR)[1]])


def test_dropping_near_duplicates(spark, corpus):
    d = clashing(docs(spark, corpus))
    kept = N.drop_near_duplicates(d)
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    group, s = classes_of(corpus)
    assert kept.columns == d.columns
    per_class = Counter(id(group[t or ""]) for (_, t), n in got.items() for _ in range(n) if len(s[t or ""]))
    assert set(per_class.values()) == {1} and len(per_class) == len({id(group[t or ""]) for _, t, *_ in corpus if len(s[t or ""])})
    wordless = [r for r in corpus if not len(s[r[1] or ""])]
    assert sum(n for (_, t), n in got.items() if not len(s[t or ""])) == len(wordless)


def test_nothing_to_compare(spark):
    assert N.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert N.drop_near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    got = N.near_duplicates(docs(spark, [(1, words(1, 50)), (2, words(2, 50))])).collect()
    assert all(r.kept and r.class_size == 1 for r in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14))
def test_alignment(x, y):
    """Against the textbook table of longest common subsequences."""
    a, b = (N.labelled_shingles(np.array(v, dtype=np.uint64) + np.uint64(1), 2) for v in (x, y))
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + (a[i] == b[j]))
    same = int(table[-1, -1])
    want = same / (len(a) + len(b) - same) if len(a) and len(b) else 0.0
    got = N.similarity(a, b, 0.5)
    assert got == pytest.approx(want) if want >= 0.5 else got < 0.5


def test_sketches_follow_order():
    """Swapped halves share all shingles but few sketches."""
    w = word_hashes(words(1, 200).encode())
    a, b = N.labelled_shingles(w), N.labelled_shingles(np.concatenate([w[100:], w[:100]]))
    c = N.labelled_shingles(np.concatenate([w[:90], w[92:]]))
    agree = lambda x, y: int((N.sketches(x) == N.sketches(y)).sum())
    assert agree(a, c) > agree(a, b) + 5


# --- pipeline

def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "near-duplicates", "decontamination", "source mixing", "token files"]
    d = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    out = []
    for _, stage in corpus_pipeline.STAGES:
        assert out == [] or d.columns == out[0].columns
        out.append(d)
        d = stage(spark, d, FOLDER)
        d = spark.createDataFrame(d.collect(), d.schema)
    good, near, clean, mixed = out[1:]
    assert good.count() < out[0].count() and near.count() < good.count()
    assert all(brute(r.text, items, 10)[1] == 0 for r in clean.collect())
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    group, _ = classes_of([tuple(r) for r in good.select("doc_id", "text").collect()])
    assert near.count() == len({id(g) for g in group.values()})
    from tokenizers import Tokenizer

    from tideframe.llm.token_files import default_tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    want = sorted((r.doc_id, t.encode(r.text, add_special_tokens=False).ids + [1]) for r in mixed.collect())
    assert sorted((r.doc_id, list(r.ids)) for r in d.collect()) == want


@pytest.mark.parametrize("k", range(4))
def test_stages_stand_odd_rows(spark, k):
    d = clashing(docs(spark, odd_rows()))
    out = corpus_pipeline.STAGES[k][1](spark, d, FOLDER)
    assert out.columns == d.columns
    rows = out.collect()
    assert len(rows) <= 1000
    ours = set(DOCS.replace(",", "").split()[::2])
    assert all(r[c] == "clash" for r in rows for c in d.columns if c not in ours)
    assert corpus_pipeline.STAGES[k][1](spark, d.limit(0), FOLDER).count() == 0


def test_run_is_registered(spark):
    a = QUERIES["pipeline"](spark, FOLDER)
    assert a.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "ids"] and a.count() > 0

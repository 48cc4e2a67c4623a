"""Exact dedup, Poisson mixing, line templates: only built-in functions, and right on odd rows."""

from __future__ import annotations

from collections import Counter

import hashlib
import random
import re
from math import ceil

import pytest
from pyspark.sql import functions as F

import verify
from tests.conftest import plan
from tests.llm.fixtures import DOCS, clashing, docs, odd_rows
from tideframe.llm.exact_dedup import exact_dedup
from tideframe.llm import line_templates as L
from tideframe.llm.line_templates import drop_template_lines
from tideframe.llm.oracle import ORACLE
from tideframe.llm.poisson_mix import poisson_cdf, poisson_mix
from tideframe.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_equals_sql(spark, name):
    assert verify.compare(spark, verify.connect(FOLDER), FOLDER, name) is None


@pytest.mark.parametrize("name", ["op4_poisson_mix", "op5_exact_dedup", "op9_line_templates"])
def test_no_python_and_no_cross_join(spark, name):
    p = plan(QUERIES[name](spark, FOLDER))
    assert not any(w in p for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoopJoin"))


def kept_of(rows):
    """Brute force of exact dedup: Counter of (doc_id, keep_id, group_size, kept)."""
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc)
    out = Counter()
    for ids in groups.values():
        best = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            out[i, best, len(ids), i == best and first] += 1
            first = first and i != best
    return out


@pytest.mark.parametrize("salts", [1, 5])
def test_exact_dedup_of_odd_rows(spark, salts):
    rows = exact_dedup(clashing(docs(spark, odd_rows())), salts)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows.collect())
    assert got == kept_of(odd_rows())


def test_exact_dedup_compares_texts_not_digests(spark):
    rows = [(i, f"text {i % 3}") for i in range(12)]
    got = exact_dedup(docs(spark, rows), 2, digest=lambda text: F.lit(b"same")).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == kept_of(rows)


def test_exact_dedup_of_case_and_blanks(spark):
    got = exact_dedup(docs(spark, [(1, "a"), (2, "A"), (3, "a "), (4, "a")])).collect()
    assert {r.doc_id: r.keep_id for r in got} == {1: 4, 2: 2, 3: 3, 4: 4}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    for f in (exact_dedup, poisson_mix, drop_template_lines):
        assert f(none).count() == 0


def test_poisson_cdf(spark):
    from math import exp, factorial

    r = spark.range(1).select(poisson_cdf(F.lit(2.5)).alias("c"), poisson_cdf(F.lit(0.0)).alias("z"),
                              poisson_cdf(F.lit(900.0)).alias("h")).first()
    want = [sum(exp(-2.5) * 2.5**i / factorial(i) for i in range(k + 1)) for k in range(8)]
    assert r.c[:8] == pytest.approx(want) and r.c[-1] == pytest.approx(1) and r.z == [1.0]
    assert r.h[-1] == pytest.approx(1) and r.h[900] == pytest.approx(0.5089, abs=1e-3)


def test_mix_meets_the_weights(spark):
    rows = [(i, "x" * 99, "en", "big" if i % 4 else None, 99) for i in range(8000)]
    d = docs(spark, rows)
    mixed = poisson_mix(d, {"big": 1.0, None: 3.0})
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert n["big"] == pytest.approx(2000, rel=0.1) and n[None] == pytest.approx(6000, rel=0.1)
    again = poisson_mix(d.repartition(7), {"big": 1.0, None: 3.0})
    key = ["doc_id", "mix_copy", "mix_order"]
    assert sorted(mixed.select(key).collect()) == sorted(again.select(key).collect())
    counts = Counter(r.doc_id for r in mixed.filter("source is null").collect())
    assert max(counts.values()) > 4 and all(  # copies are numbered without gaps
        {r.mix_copy for r in mixed.filter(f"doc_id = {i}").collect()} == set(range(1, n + 1))
        for i, n in list(counts.items())[:2])


def test_mix_without_a_weight(spark):
    d = docs(spark, [(1, "a", "en", "s", 1), (2, "b", "en", "t", 1)])
    assert {r.source for r in poisson_mix(d, {"s": 1.0}).collect()} <= {"s"}
    with pytest.raises(ValueError):
        poisson_mix(d, {"other": 1.0})


def test_mix_of_odd_rows_and_many_sources(spark, monkeypatch):
    import tideframe.llm.poisson_mix as M

    d = clashing(docs(spark, odd_rows()))
    small = sorted(map(str, M.poisson_mix(d, epochs=5.0).drop("mix_rate").collect()))
    monkeypatch.setattr(M, "broadcast_if_small", lambda x: x)
    assert sorted(map(str, M.poisson_mix(d, epochs=5.0).drop("mix_rate").collect())) == small
    same = Counter(r.mix_copies for r in M.poisson_mix(d, epochs=5.0).filter("doc_id = 4").collect())
    assert len(same) <= 1  # rows that repeat a doc_id share its draw


BOILER = "Page 3 of 17 printed by user bob9 today"


def test_templates_of_variable_fields(spark):
    rows = [
        (1, f"First line of its own kind here\n{BOILER}"),
        (2, "Second document says other things entirely\nPage 4 of 99 printed by user al7 today\nshort line"),
        (3, "short line\n\nPage 12 of 12 printed by user x1 now\nshort line"),
    ]
    got = {r.doc_id: r for r in drop_template_lines(docs(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[1].n_dropped == 0
    assert got[2].text == "Second document says other things entirely\nshort line" and got[2].n_dropped == 1
    assert got[3].text == "short line\n\nshort line" and got[3].n_lines == 4  # 7 of 8 tokens agree


def test_lines_of_one_document_stay(spark):
    text = "\n".join([BOILER] * 3)
    got = drop_template_lines(docs(spark, [(1, text), (1, text), (2, "x")])).collect()
    assert all(r.n_dropped == 0 for r in got)


def test_templates_of_odd_rows(spark):
    rows = odd_rows() + [(8, BOILER), (9, BOILER), (None, BOILER), (None, BOILER)]
    got = Counter((r.doc_id, r.text, r.n_dropped) for r in drop_template_lines(clashing(docs(spark, rows))).collect())
    assert sum(got.values()) == len(rows)
    assert got[8, BOILER, 0] == got[9, "", 1] == 1 and got[None, "", 1] == 2
    assert got[1, "", 0] == 1 and got[4, "same text here", 0] == 2


def test_families_of_one_leaf_are_told_apart(spark):
    """Three families with fields of letters, one of them more frequent, in the same leaf."""
    names = ["ann", "bob", "cid", "dan", "eve"]
    lines = ["Posted by the admin on page one today"] * 6
    lines += [f"Posted by the user {x} in forum today" for x in names]
    lines += [f"Posted by the {x} team of this site" for x in ("green", "red", "blue")]
    lines += ["Posted by the way nobody ever reads this"]
    got = {r.doc_id: r.n_dropped for r in drop_template_lines(docs(spark, list(enumerate(lines)))).collect()}
    assert [got[i] for i in range(len(lines))] == [0] + [1] * 5 + [0] + [1] * 4 + [0] + [1] * 2 + [0]


def parents_of(lines, depth=3, similar=0.8):
    """Brute force of more_frequent: {mask: parent's mask}."""
    def cuts(n):
        parts = n - ceil(similar * n) + 1
        return [(depth + b * (n - depth) // parts, depth + (b + 1) * (n - depth) // parts) for b in range(parts)]

    def name(m):
        return lines[m], hashlib.md5(m.encode()).digest()

    out = {}
    for m in lines:
        t, found = m.split(), []
        for a, b in cuts(len(t)):
            same = [x for x in lines if len(x.split()) == len(t) and x.split()[:depth] == t[:depth]
                    and x.split()[a:b] == t[a:b]]
            found.append(max(same, key=name))
        found = [x for x in found if name(x) > name(m)
                 and sum(p == q for p, q in zip(x.split(), t)) >= ceil(similar * len(t))]
        if found:
            out[m] = max(found, key=name)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_parents_equal_brute_force(spark, seed):
    r = random.Random(seed)
    lines = {" ".join(["a", "b", r.choice("cd"), *(r.choice("xyz") for _ in range(n - 3))]): r.randrange(1, 9)
             for n in (5, 6, 9, 10, 15) for _ in range(25)}
    rows = [(" ".join(m.split()[:3]) + str(len(m.split())), hashlib.md5(m.encode()).digest(), n, m) for m, n in lines.items()]
    df = spark.createDataFrame(rows, "leaf string, line binary, n_docs long, mask string")
    df = df.withColumn("leaf", F.xxhash64("leaf")).withColumn("tokens", F.split("mask", " "))
    masks = {hashlib.md5(m.encode()).digest(): m for m in lines}
    parents = L.more_frequent(df)
    got = {masks[bytes(x.line)]: masks[bytes(x.parent)] for x in parents.collect()}
    assert got == parents_of(lines) and got
    roots = {masks[bytes(x.line)]: masks[bytes(x.template)] for x in L.templates(parents).collect()}
    for m, root in roots.items():
        while m in got:
            m = got[m]
        assert m == root


def all_parents_of(lines, depth=3, similar=0.8):
    """Brute force of every_more_frequent: all pairs of lines."""
    def name(m):
        return lines[m], hashlib.md5(m.encode()).digest()

    out = {}
    for m in lines:
        t = m.split()
        found = [x for x in lines if name(x) > name(m) and len(x.split()) == len(t) and x.split()[:depth] == t[:depth]
                 and sum(p == q for p, q in zip(x.split(), t)) >= ceil(similar * len(t))]
        if found:
            out[m] = max(found, key=name)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_every_more_frequent_line_equals_brute_force(spark, seed):
    r = random.Random(seed)
    lines = {" ".join(["a", "b", r.choice("cd"), *(r.choice("xyz") for _ in range(n - 3))]): r.randrange(1, 9)
             for n in (5, 10, 10, 12, 15, 20) for _ in range(60)}
    for m in list(lines)[::3]:  # lines that differ in a few places
        t = m.split()
        for i in r.sample(range(3, len(t)), 2):
            t[i] = r.choice("xyz")
        lines.setdefault(" ".join(t), r.randrange(1, 9))
    rows = [(" ".join(m.split()[:3]) + str(len(m.split())), hashlib.md5(m.encode()).digest(), n, m) for m, n in lines.items()]
    df = spark.createDataFrame(rows, "leaf string, line binary, n_docs long, mask string")
    df = df.withColumn("leaf", F.xxhash64("leaf")).withColumn("tokens", F.split("mask", " "))
    masks = {hashlib.md5(m.encode()).digest(): m for m in lines}
    got = {masks[bytes(x.line)]: masks[bytes(x.parent)] for x in L.every_more_frequent(df).collect()}
    assert got == all_parents_of(lines) and got != parents_of(lines)


def test_a_line_is_searched_by_one_pattern_unless_it_is_odd(spark):
    """Each RLIKE reads all characters of a line; the query's time was mostly these."""
    seen = plan(L.seen_lines(L.located(docs(spark, [(1, BOILER)]))))
    assert seen.count("RLIKE") == 1 and seen.count("regexp_replace(") == 2


def test_masks_of_odd_lines(spark):
    def mask(line):
        tokens = re.sub("[ \t\r\f]+", " ", line).strip(" ").split(" ")
        return " ".join("<*>" if re.search("[0-9@]", t) else t for t in tokens)

    r = random.Random(9)
    parts = ["a", "b7", "@", "\u00e9\u00e8", "c", " ", " ", "  ", "\t", "\r", "\f", "\n", "\n", "\x0b", "\u00a0", "<*>"]
    texts = ["", " ", "\n", " \n ", "\t\n\t", "a \n b  c\nd e", *("".join(r.choices(parts, k=30)) for _ in range(200)), None]
    rows = docs(spark, list(enumerate(texts))).select("text", L.masks_of(F.col("text")).alias("masks")).collect()
    assert len(rows) == len(texts)
    for x in rows:
        lines = (x.text or "").split("\n")
        assert x.masks == [mask(line) for line in lines]
    masks = F.array(*(F.lit(" ".join("abcdef"[:n])) for n in range(7)))
    for least in range(1, 8):
        (got,) = spark.range(1).select(L._long(masks, least).alias("x")).collect()
        assert got.x == [m for m in (" ".join("abcdef"[:n]) for n in range(7)) if len(m.split(" ")) >= least]


def test_a_document_of_many_recurring_lines(spark):
    lines = [f"this is the recurring line {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} of many x{i // 100}" for i in range(1500)]
    got = {r.doc_id: r for r in drop_template_lines(docs(spark, [(1, "\n".join(lines)), (2, "\n".join(lines))])).collect()}
    assert got[1].n_dropped == 0 and got[2].n_dropped == len(lines) and got[2].text == ""


def test_lines_must_be_longer_than_the_tree_is_deep(spark):
    with pytest.raises(ValueError):
        drop_template_lines(docs(spark, [(1, "a")]), min_tokens=3)

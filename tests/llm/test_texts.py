"""HTML extraction, chat formatting, language identification."""

from __future__ import annotations

import hashlib
import html
import json
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.fixtures import DOCS, clashing, docs, odd_rows
from tideframe.llm import chat_format as C
from tideframe.llm import html_text as H
from tideframe.llm import language_id as L
from tideframe.llm.queries import FAKE, QUERIES

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"

# --- pages


def article_of(page: str) -> str:
    """Brute force for the pages of the test tables."""
    m = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", m[1]) if m else []
    texts = (" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in parts)
    return "\n\n".join(t for t in texts if t)


def test_pages_of_the_table(spark):
    got = {r.page_id: r for r in QUERIES["op6_main_text"](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        assert got[r.page_id].text == article_of(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


HEAD = "<html><head><title>T &amp; t</title><script>if (a<b) x('</p>')</script></head><body class='post-12'>"


@pytest.mark.parametrize("page, text", [
    ("<p>One&nbsp;&amp; two\n three<br>four</p>", "One & two three four"),
    ("<div id=main><h1>Head</h1><p>Some text<p>More <b>bold</b>text</div>", "Head\n\nSome text\n\nMore boldtext"),
    ("<nav>Home</nav><div class='content'><p>Body of text, long enough</p><aside>No</aside><form>No</form></div>"
     "<footer>No</footer>", "Body of text, long enough"),
    ("<article><p>Text, text</p><section class='comments'><p>I disagree, " + "very " * 90 + "</p></section></article>", "Text, text"),
    ("<article><ul><li>a<li>b</ul><!-- <p>no</p> --><style>p{}</style><p hidden>no</p></article>", "a\n\nb"),
    ("<article title='a>b'><p class=\"x>y\">Quoted</p></article>", "Quoted"),
    ("<div class='cookie-notice'>We use cookies</div><article><header><h1>Title</h1></header><p>T</p></article>", "Title\n\nT"),
    ("<main><table><tr><td>1<td>2</table></main>", "1\n\n2"),
    ("<p>&lt;b&gt; &#233;&#x41; &unknown;", "<b> éA &unknown;"),
    ("no markup at all", "no markup at all"), ("", ""), ("<", "<"), ("<script>never closed", ""), ("<!-- open", ""),
])
def test_extract(page, text):
    assert H.extract(HEAD + page if page.startswith("<") and page != "<" else page, None) == text


LONG = "a long passage, with commas, " * 60


@pytest.mark.parametrize("page, text", [
    (f"<article><h1>T</h1><div class=lead><p>Lead</p></div><div class=content><p>{LONG}</p></div></article>", f"T\n\nLead\n\n{LONG.strip()}"),
    (f"<article><h1>T</h1><p>First</p><section><p>{LONG}</p></section><section><p>Last</p></section></article>",
     f"T\n\nFirst\n\n{LONG.strip()}\n\nLast"),
    (f"<main><h1>T</h1><div><p>{LONG}</p></div></main>", f"T\n\n{LONG.strip()}"),
    (f"<main><p>Not this</p><article><h1>T</h1><section><p>{LONG}</p></section></article></main>", f"T\n\n{LONG.strip()}"),
    (f"<div class='post no-sidebar'><h1>T</h1><p>{LONG}</p></div>", f"T\n\n{LONG.strip()}"),
    (f"<div class='site right-sidebar'><article><p>{LONG}</p></article><div class=sidebar>About us</div></div>", LONG.strip()),
    (f"<article><p>{LONG}</p><div class=related>More of it</div></article>", LONG.strip()),
    (f"<div class=related><a href=x>{LONG}</a></div><article><p>Short</p></article>", "Short"),
    (f"<body><form action=x><div class=nav>Home</div><div class=text><p>{LONG}</p></div></form></body>", LONG.strip()),
    (f"<body><div class=text><p>{LONG}</p></div><form><p>Your name</p><label>Name</label></form></body>", LONG.strip()),
    (f"<div class='post comment-open'><p>{LONG}</p></div>", LONG.strip()),
    (f"<section class='story subscribe-wall'><p>{LONG}</p></section><div class=comments><p>No</p></div>", LONG.strip()),
    (f"<div class='recipe cookie'><h1>T</h1><p>{LONG}</p></div><div><p>A note</p></div>", f"T\n\n{LONG.strip()}"),
    (f"<div class=comments><p>{LONG}</p></div><div class=text><p>Short text</p></div>", "Short text"),
    (f"<div class=page><h1>T</h1><section class=a><p>{LONG}</p></section><section class=b><p>{LONG}</p></section></div>",
     f"T\n\n{LONG.strip()}\n\n{LONG.strip()}"),
    (f"<div class=page><h1>T</h1><div class=a><p>{LONG}</p></div><div class=b><p>Last</p></div></div>", f"T\n\n{LONG.strip()}\n\nLast"),
    (f"<div id=w><header><h1>Site</h1></header><div class=c><p>{LONG}</p></div><div class=d><a href=x>More</a></div></div>", LONG.strip()),
    (f"<div id=w><h1><a href=/>Site</a></h1><div class=c><p>{LONG}</p></div></div>", LONG.strip()),
    (f"<div class=legal><p>{LONG * 4}</p></div><div class=c><p>{LONG * 50}</p></div>", (LONG * 50).strip()),
    ("<div>" * 20 + f"<div class=q><p>{LONG}</p></div>" + "</div>" * 20, LONG.strip()),
    ("<div>" * 13 + f"<div><p>{LONG}</p></div>" + "</div>" * 13 + "<section>" + "<div>" * 13 + "<p>No</p>" + "</div>" * 13 + "</section>", LONG.strip()),
])
def test_whole_articles(spark, page, text):
    assert H.extract(page, None) == text
    rows = [(i, f"http://a.example/{i}", page) for i in range(3)]
    assert {r.text for r in H.main_text(spark.createDataFrame(rows, PAGES)).collect()} == {text}


def test_host_consensus(spark):
    """A page whose advert is the longest text is read with its siblings' path."""
    body = "<div class='story-{0}'><p>{1}</p></div><div class='x{0}'><p>{2}</p></div>"
    rows = [(i, f"http://User@News.Example:80/{i}", body.format(i, f"Story {i}, " + "words, " * 40, "short"))
            for i in range(5)]
    rows += [(9, "https://news.example/9?q", body.format(9, "Tiny story", "buy this, " * 90)), (10, "https://other.example", body.format(9, "Tiny", "buy this, " * 90))]
    got = {r.page_id: r.text for r in H.main_text(clashing(spark.createDataFrame(rows, PAGES))).collect()}
    assert got[9] == "Tiny story" and got[10].startswith("buy this") and got[3].startswith("Story 3")


def test_odd_pages(spark):
    deep = "<div><b>" * 5000 + "deep" + "<p>"
    rows = [(1, None, None), (None, "no url", ""), (2, "http://a/", deep), (2, "http://a/", deep), (3, "http://a/", "<p>" + "x, " * 200_000)]
    got = sorted(((r.page_id, len(r.text)) for r in H.main_text(spark.createDataFrame(rows, PAGES)).collect()), key=str)
    assert got == sorted([(1, 0), (None, 0), (2, 4), (2, 4), (3, 599_999)], key=str)
    assert H.main_text(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("unit", [
    "<a x ", "<i></u>", "<i><div></div>", "<a x='", "<a \"'>", "<!--", "</script ", "<li><ul><i>", "<li></li>", "<header>", "<div><h1>",
    "<p><b>", "<table><td>", "<![CDATA[", "<title>", "<a href=\"x>", "<form><p>", "<div class=reply>x",
])
def test_time_grows_with_length(unit):
    """Broken markup of 200 KB; a quadratic reader needs minutes."""
    page = unit * (200_000 // len(unit))
    for p in (page, "<script></script>" + page + ">"):
        begun = time.process_time()
        H.extract(p, None)
        assert time.process_time() - begun < 10


def test_deep_stacks_take_linear_time():
    page = "<ul><li><ul>" + "<i>" * 50_000 + "<li></li></b></u>" * 50_000
    begun = time.process_time()
    H.extract(page, None)
    assert time.process_time() - begun < 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</i>", "<article>", "<li", "'", '"', ">", "<!--", "&amp", "t ", "</body>"]), max_size=40))
def test_any_markup(parts):
    H.extract("".join(parts), "body>article")


# --- chats

@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\n\nim_start>end a"), st.text(alphabet="<|\\\nn a>"))
def test_escaping_is_reversible(text, role):
    assert C.unescaped(C.escaped(text)) == text and "<|" not in C.escaped(text)
    p, a, b = C.piece(role, text)
    assert C.parsed(p) == [(role, text)] and C.unescaped(p[a:b]) == text
    assert C.parsed(p + C.piece("x", FAKE)[0]) == [(role, text), ("x", FAKE)]


@pytest.mark.parametrize("record, turns", [
    ({"role": "user", "text": "hi", "extra": {"a": [1]}}, [("user", "hi")]),
    ({"messages": [{"role": "system", "content": "s"}, {"role": "gpt", "content": None}]}, [("system", "s"), ("assistant", "")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, [("user", "ab")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "s"},
     [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "x", "output": "y"}, [("user", "do\n\nx"), ("assistant", "y")]),
    ({"instruction": "do", "output": "y"}, [("user", "do"), ("assistant", "y")]),
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "r", "history": [["q1", "a1"], ["q2", "a2"]]},
     [("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "p"), ("assistant", "r")]),
    ({"question": "q", "answer": 4}, [("user", "q"), ("assistant", "4")]),
    ({"unknown": 1}, None), ([], None), (3, None), ({"messages": []}, None),
])
def test_layouts(record, turns):
    assert C.turns(record) == turns


@pytest.mark.parametrize("record, turns", [
    ({"system": "s", "messages": [{"role": "user", "content": "q"}]}, [("system", "s"), ("user", "q")]),
    ({"system": "s", "messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]}]}, [("system", "s"), ("user", "q")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]}, {"role": "assistant", "content": "a"}], "system": "s"},
     [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": [{"text": "q"}]}, {"role": "assistant", "content": None}]}, [("user", "q"), ("assistant", "")]),
])
def test_messages_with_system_and_mixed_content(record, turns):
    assert C.turns(record) == turns


@pytest.mark.parametrize("record, turns", [
    ({"prompt": "p", "prompt_id": "1", "messages": [{"role": "human", "content": "q"}]}, [("user", "q")]),
    ({"instruction": "do", "output": "y", "text": "all of it"}, [("user", "do"), ("assistant", "y")]),
    ({"question": "q", "answer": "a", "system": "s"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"question": "q", "answer": "a", "context": "c"}, [("user", "c\n\nq"), ("assistant", "a")]),
    ({"prompt": "p", "completion": "c", "system": "s"}, [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"conversations": [{"from": "human", "value": "q"}], "text": "t"}, [("user", "q")]),
    ({"conversations": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "q"}, None, 3, "x"], "answer": "a"}, [("user", "q")]),
    ({"prompt": "p", "response": "r", "history": 5}, [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "response": "r", "history": ["no pair"]}, [("user", "p"), ("assistant", "r")]),
    ({"role": "human", "text": "as given"}, [("human", "as given")]),
    ({"prompt": "alone"}, None),
])
def test_records_with_more_or_other_fields(record, turns):
    assert C.turns(record) == turns


def test_what_no_mapping_names_is_kept(spark):
    """The record itself stays at hand unless its fingerprint names a mapping."""
    records = [{"question": "q", "answer": "a"}, {"question": "q", "answer": "a", "text": "t"}, {"prompt": "alone"}, {"messages": []}]
    rows = [(i, 0, json.dumps(r)) for i, r in enumerate(records)] + [(9, 0, None)]
    got = C.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, record string")).collect()
    assert {(r.conv_id, r.nth): (r.mapped, r.raw) for r in got} == {
        (0, 0): (True, None), (0, 1): (True, None), (1, 0): (True, rows[1][2]), (1, 1): (True, None),
        (2, 0): (False, rows[2][2]), (3, 0): (False, rows[3][2]), (9, 0): (False, None)}


def test_fingerprints_are_of_one_mapping_each():
    assert len(C.BY_FINGERPRINT) == sum(2 ** len(m.optional) for m in C.MAPPINGS)


def digests(rows):
    """Brute force: conv_id -> (turns, digest, loss characters, digest)."""
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        out.setdefault(c, []).append((role or "", text or ""))
    return {c: (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in ts).encode()).hexdigest(),
                len(loss := "".join(x for r, x in ts if r == "assistant")), hashlib.sha256(loss.encode()).hexdigest())
            for c, ts in out.items()}


def test_conversations_of_the_table(spark):
    got = QUERIES["op7_chat_format"](spark, FOLDER).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", FAKE), (-1, 1, "assistant", FAKE)]
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digests(rows)


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, ""), (1, 2, "assistant", "é" * 300_000), (None, None, "assistant", "x"),
            (None, 5, "assistant", "퟿\n<|im_end|>\\"), (3, 1, "assistant", "b"), (3, 1, "assistant", "b")]
    rows += [(7, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(3000)]
    table = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(4)
    out = C.format_chats(C.turn_records(table))
    assert out.filter("not mapped").count() == 0 and out.count() == len(rows)
    got = C.read_back(out).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digests(rows)
    for r in C.format_chats(C.turn_records(table)).filter("learn_from is not null").limit(20).collect():
        assert r.piece[r.learn_from:r.learn_to] + C.STOP + "\n" == r.piece[r.learn_from:]


def test_odd_records(spark):
    bad = [None, "{", "[]", '{"a": 1}', "[" * 5000, json.dumps({"prompt": "p", "completion": "c"})]
    df = spark.createDataFrame([(i, 0, b) for i, b in enumerate(bad)], "conv_id long, turn long, record string")
    got = sorted(C.format_chats(df).select("conv_id", "nth", "mapped").collect())
    assert [tuple(r) for r in got] == [(i, 0, False) for i in range(5)] + [(5, 0, True), (5, 1, True)]
    assert {r.conv_id: r.n_turns for r in C.read_back(C.format_chats(df)).collect()} == {**dict.fromkeys(range(5), 0), 5: 2}
    assert C.read_back(C.format_chats(df.limit(0))).count() == 0


# --- languages

def test_language_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_predictions_do_not_use_labels(spark):
    d = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = L.fold(d) == 0
    swapped = d.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert sorted(L.language_id(d).collect()) == sorted(L.language_id(swapped).collect())


def test_odd_languages(spark):
    d = clashing(docs(spark, odd_rows()))
    got = L.language_id(d).collect()
    assert len(got) == len(odd_rows())
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 6, 7))
    none = d.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.language_id(none).collect()} == {"und"}
    one = L.language_id(d.withColumn("lang", F.lit("pt-BR"))).filter("doc_id = 3").first()
    assert one.lang_pred == "pt-BR" and one.score == 1.0
    assert L.language_id(spark.createDataFrame([], DOCS)).count() == 0


def test_families_and_votes():
    assert L.family("en-US") == L.family("de") == "germanic" and L.family("xx") == "xx"
    r = random.Random(3)
    parts = {"en": "the and ing tion", "de": "und der sch ung", "nl": "het een ij van", "fr": "les eau que ment", "xx": "qzx zzq kwx"}
    texts = [(lang, " ".join(r.choice(p.split()) for _ in range(30))) for lang, p in parts.items() for _ in range(40)]
    x = np.stack([L.features(t) for _, t in texts])
    m = L.LanguageModel.fit(x, np.array([lang for lang, _ in texts], dtype=object))
    assert set(m.of_pair) == {("de", "en"), ("de", "nl"), ("en", "nl")} and set(m.of_family) == {"germanic", "romance", "xx"}
    pred, score = m.predict(x)
    assert pred == [lang for lang, _ in texts] and score.min() > 0.5

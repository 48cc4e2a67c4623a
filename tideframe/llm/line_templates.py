"""Line deduplication by a tree of log templates.

A line is masked (tokens with a digit or an @ become ``<*>``) and
sent down a tree of fixed depth: token count, then the leading tokens.  A leaf
holds any number of templates: a line belongs to that of the line found in most
documents among those that agree with it in most places, and so on from there;
the other places are variable.  A line that agrees with no more frequent one is
a template itself.  Templates of two or more documents recur: the first
document keeps its lines, all others lose them.

Lines that may differ in k places are cut into k + 1 blocks, one of which two
agreeing lines share.  So a line is compared with the most frequent line of each
of its blocks, whatever the size of the leaf; where these do not agree, also with
those other lines of the block that could be its template.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.llm.common import written

#: Lines with fewer tokens are left alone.
MIN_TOKENS = 5
#: Leading tokens that the tree looks at.
DEPTH = 3
#: Share of equal places from which two lines agree.
SIMILAR = 0.8
#: A variable field, and what only lines with such fields hold.
FIELD, MARK = r"[^ 0-9@]*[0-9@][^ ]*", r"[0-9@]"
BLANKS, ODD = r"[ \t\r\f]+", ("\t", "\r", "\f", "  ")  # the latter sought as bytes, without a pattern


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def even(line: Column) -> Column:
    """The line with one space between its tokens and none at its ends."""
    odd = reduce(or_, (F.contains(line, F.lit(x)) for x in ODD))
    return F.trim(F.when(odd, F.regexp_replace(line, BLANKS, " ")).otherwise(line))


def masked(line: Column) -> Column:
    """An even line with its variable fields as <*>."""
    return F.when(F.rlike(line, F.lit(MARK)), F.regexp_replace(line, FIELD, "<*>")).otherwise(line)


def masks_of(text: Column) -> Column:
    """The masked lines, in the order of ``lines_of``.

    What ``masked`` names more than once is worked out anew each time, so it gets lines made even before.
    """
    return F.transform(F.transform(lines_of(text), even), masked)


def n_tokens(mask: Column) -> Column:
    """Tokens of a masked line."""
    return F.octet_length(mask) - F.octet_length(F.replace(mask, F.lit(" "))) + 1


def digest(mask: Column) -> Column:
    return F.unhex(F.md5(mask))


def _long(masks: Column, least: int) -> Column:
    """Those of at least so many tokens, so of one space less at least; no more of a line is read than these."""
    return F.filter(masks, lambda m: F.substring_index(m, " ", least - 1) != m) if least > 1 else masks


def located(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of both, by which a document is found again."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("place"))


def seen_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, depth: int = DEPTH) -> DataFrame:
    """doc_id, place, leaf, line: the different lines of each document, as digests."""
    masks = _long(masks_of(F.col("text")), min_tokens)

    def entry(m: Column) -> Column:
        leaf = F.xxhash64(n_tokens(m), F.substring_index(m, " ", depth))
        return F.struct(leaf.alias("leaf"), digest(m).alias("line"))

    rows = docs.select("doc_id", "place", F.explode(F.transform(F.array_distinct(masks), entry)).alias("e"))
    return rows.select("doc_id", "place", "e.leaf", "e.line")


def relevant_lines(seen: DataFrame) -> DataFrame:
    """leaf, line, n_docs, low, high (doc_id), place, in_leaf: the different
    lines of those leaves that several documents reach; no others can recur."""
    lines = written(
        seen.groupBy("leaf", "line").agg(
            F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"), F.min("place").alias("place"),
        ),
        "template-lines",
    )
    leaves = (
        lines.groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("in_leaf"), F.min("low").alias("a"), F.max("high").alias("b"))
        .filter("a <> b").select("leaf", "in_leaf")
    )
    return written(lines.join(leaves, "leaf"), "template-leaves")


def crowded_lines(docs: DataFrame, relevant: DataFrame) -> DataFrame:
    """leaf, line, n_docs, tokens of the lines that share a leaf with others.

    Each text is fetched from one document that holds it.
    """
    crowded = relevant.filter("in_leaf > 1").select("leaf", "line", "n_docs", "place")
    wanted = crowded.groupBy("place").agg(F.collect_list("line").alias("wanted"))
    masks = F.filter(masks_of(F.col("text")), lambda m: F.array_contains("wanted", digest(m)))
    text = (
        docs.join(wanted, "place")
        .select(F.explode(F.array_distinct(masks)).alias("mask"))
        .select("mask", digest(F.col("mask")).alias("line"))
        .groupBy("line").agg(F.min("mask").alias("mask"))  # rows that repeat a document repeat its lines
        .select("line", F.split("mask", " ").alias("tokens"))
    )
    return written(text.join(crowded.drop("place"), "line"), "template-texts")


def _least(n: Column, similar: float) -> Column:
    """Equal places from which lines of n tokens agree."""
    return F.ceil(F.lit(similar) * n).cast("int")


def _cut(b: Column, places: Column, parts: Column) -> Column:
    """The first of so many places that is in block b of so many parts."""
    return F.floor(b * places / parts).cast("int")


def _blocks(lines: DataFrame, depth: int, similar: float) -> DataFrame:
    """leaf, part, block, line, n_docs: each line in its blocks, by their numbers and a hash of their tokens."""
    n = F.size("tokens")
    rest, parts = n - depth, n - _least(n, similar) + 1

    def block(b: Column) -> Column:
        first = _cut(b, rest, parts)
        tokens = F.slice("tokens", first + depth + 1, _cut(b + 1, rest, parts) - first)
        return F.struct(b.alias("part"), F.xxhash64(b, tokens).alias("block"))

    rows = lines.select("leaf", "line", "n_docs", F.explode(F.transform(F.sequence(F.lit(0), parts - 1), block)).alias("b"))
    return rows.select("leaf", "b.*", "line", "n_docs")


def _judged(met: DataFrame, lines: DataFrame, similar: float) -> DataFrame:
    """line, parent, parent_docs, agrees: pairs with the word whether they agree.

    Tokens are compared place by place; <*> equals only <*>.
    """
    n, texts = F.size("tokens"), lines.select("line", "tokens")
    both = met.select("line", "parent", "parent_docs").distinct().join(texts, "line").join(
        texts.select(F.col("line").alias("parent"), F.col("tokens").alias("its")), "parent")
    equal = F.size(F.filter(F.zip_with("tokens", "its", lambda x, y: x == y), lambda e: e))
    return both.select(
        "line", "parent", "parent_docs", ((equal >= _least(n, similar)) & (F.size("its") == n)).alias("agrees"))


def _best(judged: DataFrame) -> DataFrame:
    """line, best: of the lines it agrees with the most frequent one."""
    best = F.max(F.struct(F.col("parent_docs").alias("n_docs"), F.col("parent").alias("line")))
    return judged.filter("agrees").groupBy("line").agg(best.alias("best"))


def _met(blocks: DataFrame) -> DataFrame:
    """leaf, part, block, line, n_docs, parent, parent_docs: each line and the most
    frequent one of each of its blocks, if that is another."""
    name = F.struct("n_docs", "line")
    tops = blocks.groupBy("leaf", "part", "block").agg(F.max(name).alias("top"), F.count(F.lit(1)).alias("n"))
    return (
        blocks.join(tops.filter("n > 1").drop("n"), ["leaf", "part", "block"]).filter(F.col("top") > name)
        .select(*blocks.columns, F.col("top.line").alias("parent"), F.col("top.n_docs").alias("parent_docs"))
    )


def more_frequent(lines: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """line, parent: of each line the most frequent one it agrees with, among the
    most frequent of its blocks, if that is found in more documents (ties: a
    larger digest).  ``every_more_frequent`` looks at all others as well."""
    judged = _judged(_met(_blocks(lines, depth, similar)), lines, similar)
    return _best(judged).select("line", F.col("best.line").alias("parent"))


def every_more_frequent(lines: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """line, parent: of each line the most frequent one it agrees with, of all lines
    of the leaf that are found in more documents (ties: a larger digest).

    A line that agrees with the most frequent one of a block has found the best
    there.  One that does not is compared with the others of that block that are
    more frequent than itself and than the best it found elsewhere.  Agreeing
    lines differ in at most k of the places outside the block as well, so these
    are cut into k + 1 blocks in turn, and only lines that share one are compared.
    """
    at = ["leaf", "part", "block"]
    blocks = _blocks(lines, depth, similar)
    met = written(_met(blocks), "template-tops")
    judged = written(_judged(met, lines, similar), "template-judged")
    found = _best(judged)
    top = F.struct(F.col("parent_docs").alias("n_docs"), F.col("parent").alias("line"))
    seekers = (
        met.join(judged.filter(~F.col("agrees")).select("line", "parent"), ["line", "parent"])
        .join(found, "line", "left")
        .select(*at, "line", F.greatest(F.struct("n_docs", "line"), "best").alias("above"), top.alias("below"))
        .filter("above < below")
    )
    # of a block, what lies between the least that is sought and its top
    sought = seekers.groupBy(*at).agg(F.min("above").alias("above"), F.max("below").alias("below"))
    name = F.struct("n_docs", "line")
    between = blocks.join(sought, at).filter((name > F.col("above")) & (name < F.col("below")))

    def finer(rows: DataFrame) -> DataFrame:
        n = F.size("tokens")
        rest, parts = n - depth, n - _least(n, similar) + 1
        start, end = (_cut(F.col("part") + b, rest, parts) for b in (0, 1))
        others = F.concat(F.slice("tokens", F.lit(depth + 1), start), F.slice("tokens", end + depth + 1, rest - end))

        def block(b: Column) -> Column:
            first = _cut(b, F.size("others"), parts)
            return F.xxhash64(b, F.slice("others", first + 1, _cut(b + 1, F.size("others"), parts) - first))

        placed = rows.join(lines.select("line", "tokens"), "line").withColumn("others", others)
        blocks_of = F.transform(F.sequence(F.lit(0), parts - 1), block)
        return placed.withColumn("finer", F.explode(blocks_of)).drop("tokens", "others")

    others = finer(between.select(*at, "line", "n_docs")).select(
        *at, "finer", F.col("line").alias("parent"), F.col("n_docs").alias("parent_docs"))
    further = finer(seekers).join(others, [*at, "finer"]).filter((top > F.col("above")) & (top < F.col("below")))
    all_judged = judged.unionByName(_judged(further, lines, similar))
    return _best(all_judged).select("line", F.col("best.line").alias("parent"))


def templates(parents: DataFrame) -> DataFrame:
    """line, template: parents are followed to the last, by doubling until none moves.

    A parent is always before its line in one order, so there are no rings.
    """
    links = written(parents.select("line", F.col("parent").alias("template")), "template-links")
    while True:
        further = links.select(F.col("line").alias("template"), F.col("template").alias("beyond"))
        moved = written(
            links.join(further, "template", "left").select(
                "line", F.coalesce("beyond", "template").alias("template"), F.col("beyond").isNotNull().alias("moved")),
            "template-links",
        )
        links = moved.select("line", "template")
        if moved.filter("moved").isEmpty():
            return links


def recurring_lines(
    docs: DataFrame, relevant: DataFrame, depth: int = DEPTH, similar: float = SIMILAR
) -> DataFrame:
    """line, first_doc: lines whose template is in several documents, and the
    smallest doc_id among these."""
    joined = templates(every_more_frequent(crowded_lines(docs, relevant), depth, similar))
    placed = relevant.select("line", "low", "high").join(joined, "line", "left")
    placed = placed.withColumn("template", F.coalesce("template", "line"))
    several = (
        placed.groupBy("template")
        .agg(F.min("low").alias("first_doc"), F.max("high").alias("last_doc"))
        .filter("first_doc <> last_doc")
        .select("template", "first_doc")
    )
    return placed.join(several, "template").select("line", "first_doc")


def drop_template_lines(
    docs: DataFrame, min_tokens: int = MIN_TOKENS, depth: int = DEPTH, similar: float = SIMILAR
) -> DataFrame:
    """doc_id, text without the dropped lines, n_lines, n_dropped; a row per row of ``docs``.

    Documents are told apart by doc_id: rows that repeat one are one document,
    and a NULL doc_id is nobody's first document, so such rows lose lines that
    recur elsewhere.  NULL text is an empty text of one line; empty lines and
    lines of few tokens stay.  Other columns are not read.  An empty table
    stays empty.
    """
    if min_tokens <= depth or (1 - similar) * min_tokens >= min_tokens - depth:
        raise ValueError("lines need more tokens than the tree looks at and may differ in")
    docs = located(docs)
    seen = written(seen_lines(docs, min_tokens, depth), "lines-seen")
    gone = (
        seen.join(recurring_lines(docs, relevant_lines(seen), depth, similar), "line")
        .filter(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("first_doc")))
        .groupBy("place")
        .agg(F.collect_set(F.struct(F.coalesce("doc_id", F.lit(0)).alias("doc"), "line")).alias("gone"))
    )
    lines = lines_of(F.col("text"))
    doc = F.coalesce("doc_id", F.lit(0))

    def stays(mask: Column) -> Column:
        return ~F.array_contains("gone", F.struct(doc.alias("doc"), digest(mask).alias("line")))

    left = F.when(F.col("gone").isNull(), lines).otherwise(
        F.array_compact(F.zip_with(lines, masks_of(F.col("text")), lambda x, m: F.when(stays(m), x)))
    )
    whole = docs.join(gone, "place", "left")
    return whole.select("doc_id", F.size(lines).alias("n_lines"), left.alias("left")).select(
        "doc_id", F.array_join("left", "\n").alias("text"), "n_lines",
        (F.col("n_lines") - F.size("left")).alias("n_dropped"),
    )

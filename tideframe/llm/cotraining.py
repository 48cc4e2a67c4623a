"""A quality classifier by co-training.

Two views of a document, what its text looks like and what its metadata says,
have a classifier each.  Both start from labelled documents.  In every round
each view labels the documents of the whole corpus that it is sure of, and the
other view learns from these.  What counts as sure is found on labelled
documents held out of learning.  In the end both views are calibrated, and a
small logistic model weighs them.

The classifiers are regularised least squares: one pass over the corpus gives
sums that fit both views, however large it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions.joins import broadcast_if_small
from tideframe.llm.common import columns_of, free_names, hash_spans, mix, texts, word_spans, written

#: Labelled documents to learn from, about; every fifth only calibrates.
SAMPLE = 20_000
ROUNDS = 3
#: Share of right labels among those a view may pass on, good and bad ones,
#: and how many held-out documents have to show it.
SURE_GOOD, SURE_BAD, SHOWN = 0.99, 0.95, 10
#: Weight of passed-on labels against given ones.
PASSED_ON = 0.5
#: Documents whose score is at least this stay.
KEEP = 0.5

_CLASS = np.zeros(256, dtype=np.int64)  # 0: other control or space
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 4
_CLASS[[10, 13]] = 5
_CLASS[[ord(c) for c in ".,;:'-?"]] = 6
_CLASS[[ord(c) for c in "!\"()/"]] = 7
_CLASS[[ord(c) for c in "#$%&*+=@^~`"]] = 8
_CLASS[[ord(c) for c in "|<>[]{}\\_"]] = 9
CLASSES = 10
SHAPES = 14
TEXT_FEATURES = SHAPES + CLASSES * CLASSES + 1
SOURCES, LANGS, LENGTHS = 64, 16, 24
META_FEATURES = SOURCES + LANGS + LENGTHS + 1


def text_features(raw: bytes) -> np.ndarray:
    """Shape of a text: how words repeat, which kinds of characters follow each other."""
    out = np.zeros(TEXT_FEATURES, dtype=np.float32)
    out[-1] = 1
    if not raw:
        return out
    kind = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    follow = np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=CLASSES * CLASSES)
    out[SHAPES:-1] = np.sqrt(follow / max(1, len(raw) - 1))
    start, end, b = word_spans(raw)
    h = hash_spans(start, end, b)
    n = max(1, len(h))
    once = np.unique(h, return_counts=True)[1]
    pairs = np.unique(mix(h[:-1] * np.uint64(3) + h[1:])) if len(h) > 1 else h
    same = np.flatnonzero(np.diff(h) != 0) if len(h) > 1 else np.zeros(0, dtype=int)
    run = np.diff(np.concatenate([[-1], same, [len(h) - 1]])).max() if len(h) else 0
    lines = [x for x in raw.split(b"\n") if x]
    size = end - start
    out[:SHAPES] = (
        np.log1p(len(raw)) / 10, np.log1p(len(h)) / 10, len(once) / n, len(pairs) / max(1, len(h) - 1),
        (once.max() / n) if len(h) else 0, np.log1p(run) / 5, (run > 4), (size.mean() / 10) if len(h) else 0,
        (size.std() / 10) if len(h) else 0, len(set(lines)) / max(1, len(lines)),
        np.log1p(len(lines)) / 5, len(h) / len(raw) * 5, float((kind == 2).mean()), float((kind >= 7).mean()),
    )
    return out


def meta_places(source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    """Which of the metadata features are 1."""
    def slot(x: str | None, n: int) -> int:
        return 0 if x is None else 1 + zlib.crc32(x.encode()) % (n - 1)

    long = 0 if n_chars is None else 1 + min(LENGTHS - 2, max(0, int(n_chars)).bit_length())
    return [slot(source, SOURCES), SOURCES + slot(lang, LANGS), SOURCES + LANGS + long, META_FEATURES - 1]


def batch_features(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.stack([text_features(t) for t in texts(b.column("text"))]) if b.num_rows else np.zeros((0, TEXT_FEATURES), np.float32)
    m = np.zeros((b.num_rows, META_FEATURES), dtype=np.float32)
    for i, row in enumerate(zip(*(b.column(c).to_pylist() for c in ("source", "lang", "n_chars")))):
        m[i, meta_places(*row)] = 1
    return x, m


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def logistic(z: np.ndarray, y: np.ndarray, start: np.ndarray, damp: float = 1.0) -> np.ndarray:
    """Weights of a logistic model, drawn to ``start``."""
    w = start.astype(float).copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + damp * np.eye(len(w)),
                               z.T @ (p - y) + damp * (w - start))
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class View:
    """A classifier with calibration, and the probabilities from which it is sure."""

    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    good: float = 2.0
    bad: float = -1.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (x @ self.weights) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def sure(self, x: np.ndarray) -> np.ndarray:
        """1: surely good, 0: surely bad, -1: neither."""
        p = self.probability(x)
        return np.where(p >= self.good, 1, np.where(p <= self.bad, 0, -1))


Sums = tuple[np.ndarray, np.ndarray, float]  # x'x, sum of x, rows; of one class


def sums(x: np.ndarray) -> Sums:
    x = x.astype(np.float64)
    return x.T @ x, x.sum(axis=0), float(len(x))


def fit(given: list[Sums], passed: list[Sums] | None, x: np.ndarray, y: np.ndarray) -> View:
    """Least squares to -1 and 1 with both classes weighing the same; x, y calibrate."""
    d = len(given[0][1])
    left, right = np.eye(d) * 1e-3, np.zeros(d)
    for group, weight in ((given, 1.0), (passed, PASSED_ON)):
        for target, (xx, sx, n) in zip((-1.0, 1.0), group or []):
            if n:
                left += xx * (weight / n)
                right += sx * (weight * target / n)
    view = View(np.linalg.solve(left, right))
    m = x @ view.weights
    slope, shift = logistic(np.stack([m, np.ones_like(m)], axis=1), y, np.array([3.0, 0.0]), 0.1)
    view = replace(view, slope=float(max(slope, 1e-3)), shift=float(shift))
    p = view.probability(x)
    return replace(view, good=_least_sure(p, y, SURE_GOOD), bad=1 - _least_sure(1 - p, 1 - y, SURE_BAD))


def _least_sure(p: np.ndarray, y: np.ndarray, share: float) -> float:
    """The least p from which ``share`` of the labels are right; 2 when none is shown."""
    order = np.argsort(-p, kind="stable")
    n = np.arange(1, len(p) + 1)
    fine = (np.cumsum(y[order]) >= share * n) & (n >= SHOWN)
    return float(p[order][np.flatnonzero(fine)[-1]]) if fine.any() else 2.0


@dataclass(frozen=True)
class Quality:
    text: View
    meta: View
    stack: np.ndarray

    def scores(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, q = self.text.probability(x), self.meta.probability(m)
        z = np.stack([logit(p), logit(q), np.ones(len(x))], axis=1) @ self.stack
        return p, q, 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text features, metadata features and quality of about ``sample`` labelled documents;
    of rows that share a doc_id one is read, so no more than that many are collected."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.avg("quality").alias("quality"))
    known = written(known, "quality-labels")
    n = known.count()
    share = min(1.0, sample / max(1, n))
    parts = 1_000_000
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(parts))
    chosen = known.filter(draw < F.lit(int(parts * share) + 1))
    own = chosen.select("doc_id", (F.col("quality") >= 0.5).alias("_good"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, m = batch_features(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array([r.tobytes() for r in m.astype(np.uint8)], pa.binary()), b.column("_good")], ["doc_id", "x", "m", "good"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang",
                       F.col("n_chars").cast("long").alias("n_chars"))
    seen = rows.join(broadcast_if_small(own), "doc_id").select("doc_id", "text", "source", "lang", "n_chars", "_good").mapInArrow(
        read, "doc_id long, x binary, m binary, good boolean")
    got = seen.groupBy("doc_id").agg(F.max(F.struct("x", "m", "good")).alias("row")).select("row.*").collect()
    got.sort(key=lambda r: (zlib.crc32(r.x), r.x, r.m, r.good))
    x = np.array([np.frombuffer(r.x, dtype=np.float32) for r in got]).reshape(len(got), TEXT_FEATURES)
    m = np.array([np.frombuffer(r.m, dtype=np.uint8) for r in got]).reshape(len(got), META_FEATURES)
    return x, m.astype(np.float32), np.array([r.good for r in got], dtype=float)


def corpus_features(docs: DataFrame) -> DataFrame:
    """doc_id, blank, x, m: both views of every row, the second as places; written once, read by
    every round and, in ``quality``, by the scoring."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, m = batch_features(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([not t.strip() for t in texts(b.column("text"))], pa.bool_()),
                 pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array([np.packbits(r.astype(bool)).tobytes() for r in m], pa.binary())], ["doc_id", "blank", "x", "m"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang",
                       F.col("n_chars").cast("long").alias("n_chars"))
    return written(rows.mapInArrow(run, "doc_id long, blank boolean, x binary, m binary"), "quality-features")


def views_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views from rows of ``corpus_features``."""
    x = np.array([np.frombuffer(r, dtype=np.float32) for r in b.column("x").to_pylist()], dtype=np.float32)
    m = np.array([np.unpackbits(np.frombuffer(r, dtype=np.uint8), count=META_FEATURES) for r in b.column("m").to_pylist()],
                 dtype=np.float32)
    return x.reshape(-1, TEXT_FEATURES), m.reshape(-1, META_FEATURES)


def passed_on(features: DataFrame, text: View, meta: View) -> tuple[list[Sums], list[Sums]]:
    """What each view learns from the other: sums of (text, metadata) features by class,
    over all documents of which the other view is sure."""
    d, e = TEXT_FEATURES, META_FEATURES
    size = 2 * (d * d + d + 1) + 2 * (e * e + e + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            x, m = views_of(b)
            by_meta, by_text = meta.sure(m), text.sure(x)
            parts = [z for views, sure in ((x, by_meta), (m, by_text)) for c in (0, 1)
                     for z in sums(views[sure == c])]
            total += np.concatenate([np.ravel(z) for z in parts])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["at", "value"])

    rows = features.select("x", "m").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    v = np.zeros(size)
    v[[r.at for r in rows]] = [r.value for r in rows]

    def take(n: int) -> Sums:
        nonlocal v
        xx, sx, rows = v[:n * n].reshape(n, n), v[n * n:n * n + n], v[n * n + n]
        v = v[n * n + n + 1:]
        return xx, sx, float(rows)

    return [take(d), take(d)], [take(e), take(e)]


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, features: DataFrame | None = None
) -> Quality | None:
    """The classifier; None when the labels hold fewer than two documents of either class.

    ``features`` are those of ``docs``, where the caller has them.
    """
    x, m, y = labelled(docs, labels, sample)
    if min(y.sum(), len(y) - y.sum()) < 2:
        return None
    held = np.zeros(len(y), dtype=bool)
    for c in (0, 1):  # every fifth of either class, one at least
        held[np.flatnonzero(y == c)[::5]] = True
    given_x = [sums(x[~held & (y == c)]) for c in (0, 1)]
    given_m = [sums(m[~held & (y == c)]) for c in (0, 1)]
    cx, cm, cy = x[held], m[held], y[held]
    text, meta = fit(given_x, None, cx, cy), fit(given_m, None, cm, cy)
    if features is None:
        features = corpus_features(docs)
    for _ in range(rounds):
        to_text, to_meta = passed_on(features, text, meta)
        text, meta = fit(given_x, to_text, cx, cy), fit(given_m, to_meta, cm, cy)
    prior = float(logit(np.array([cy.mean()]))[0])
    z = np.stack([logit(text.probability(cx)), logit(meta.probability(cm)), np.ones(len(cy))], axis=1)
    return Quality(text, meta, logistic(z, cy, np.array([1.0, 1.0, -prior])))


def with_verdict(docs: DataFrame, model: Quality | None, kept: str, keep: float = KEEP) -> DataFrame:
    """``docs`` and a column ``kept``: whether a row is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(kept, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.full(b.num_rows, 0.5)
            if shared.value is not None and b.num_rows:
                numbers = b.column("n_chars").cast(pa.int64())
                view = pa.RecordBatch.from_arrays(
                    [b.column("text"), b.column("source"), b.column("lang"), numbers], ["text", "source", "lang", "n_chars"])
                _, _, s = shared.value.scores(*batch_features(view))
            blank = np.array([not t.strip() for t in texts(b.column("text"))], dtype=bool)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.where(blank, 0.0, s) >= keep)], [*b.schema.names, kept])

    return docs.mapInArrow(run, schema)


def scored(features: DataFrame, model: Quality | None, keep: float = KEEP) -> DataFrame:
    """doc_id, p_text, p_meta, score, kept of every row of ``corpus_features``."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = q = s = np.full(b.num_rows, 0.5)
            if shared.value is not None and b.num_rows:
                p, q, s = shared.value.scores(*views_of(b))
            s = np.where(np.array(b.column("blank").to_pylist(), dtype=bool), 0.0, s)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p), pa.array(q), pa.array(s), pa.array(s >= keep)],
                ["doc_id", "p_text", "p_meta", "score", "kept"])

    return features.mapInArrow(run, "doc_id long, p_text double, p_meta double, score double, kept boolean")


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, p_text, p_meta, score, kept of every row of ``docs``
    (doc_id, text, lang, source, n_chars), learnt from ``labels`` (doc_id, quality).

    NULL metadata is a value of its own.  Text that is NULL or blank has score
    0 and is rejected.  Labels without doc_id or quality are left out, several
    of one document are averaged.  With fewer than two labelled documents of
    either class nothing can be learnt: all scores are 0.5 and all documents
    with text stay.  Repeated rows are each scored; other columns do not
    matter.  An empty table stays empty.
    """
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars")
    features = corpus_features(rows)
    return scored(features, train(rows, labels, sample, rounds, features))


def drop_poor(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged, with all columns whatever their names.

    NULL, blank and repeated rows are judged as in ``quality``.  An empty
    table stays empty.
    """
    model = train(docs.select("doc_id", "text", "source", "lang", "n_chars"), labels, sample, rounds)
    (kept,) = free_names(docs, "_kept")
    return with_verdict(docs, model, kept).filter(F.col(kept)).select(*columns_of(docs))

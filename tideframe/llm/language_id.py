"""Language identification in two steps.

First the family of languages is told, then, within it, one linear support
vector machine for each pair of its languages votes.  Related languages are
thus only ever compared with each other.

The models are fitted on the driver from a sample of labelled documents of at
most about ``SAMPLE`` rows; every document is then scored by its whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows to learn from, shared evenly by the languages.
SAMPLE = 6_000
FEATURES = 2048
FOLDS = 5
UNKNOWN = "und"

# Families of languages by ISO 639 code.  A code that is not
# named is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk",
    "indic": "hi bn mr gu pa ne ur",
    "dravidian": "ta te kn ml",
    "semitic": "ar he am mt",
    "austronesian": "id ms tl jv",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_LETTER = re.compile(r"[^\W\d_]")
#: Everything in ASCII that is no letter looks alike.
_PLAIN = np.arange(256, dtype=np.uint32)
_PLAIN[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def family(lang: str) -> str:
    return _FAMILY.get(re.split("[-_]", lang.lower())[0], lang)


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams; a vector of length 1."""
    b = _PLAIN[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    code = (b[:-2] * np.uint32(961) + b[1:-1] * np.uint32(31) + b[2:]) * np.uint32(2654435761)
    blank = (b[:-2] == 32) & (b[1:-1] == 32)
    n = np.bincount((code >> np.uint32(21))[~blank], minlength=FEATURES).astype(np.float32)
    return np.sqrt(n / max(n.sum(), 1.0))


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 4.0, rounds: int = 15) -> np.ndarray:
    """Weights (the last one a constant) by dual coordinate descent, squared hinge."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w, alpha = np.zeros(x.shape[1], dtype=np.float32), np.zeros(len(x))
    soft = 0.5 / c
    curve = (x * x).sum(axis=1) + soft
    order = np.random.Generator(np.random.PCG64(1))
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            gradient = y[i] * float(w @ x[i]) - 1 + soft * alpha[i]
            new = max(alpha[i] - gradient / curve[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w


def sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities of y = 1 (logistic, damped)."""
    t = (y > 0).astype(float)
    z = np.stack([margin, np.ones_like(margin)], axis=1).astype(float)
    ab = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ ab, -30, 30)))
        slope = z.T @ (p - t) + 0.5 * (ab - [3.0, 0.0])
        ab -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 0.5 * np.eye(2), slope)
    return float(max(ab[0], 1e-3)), float(ab[1])


@dataclass
class Machine:
    """A support vector machine with its calibration."""

    w: np.ndarray
    slope: float
    shift: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Machine:
        held = np.arange(len(x)) % 5 == 4
        if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
            held[:] = False
        w = linear_svm(x[~held], y[~held])
        check = held if held.any() else ~held
        return cls(w, *sigmoid(x[check] @ w[:-1] + w[-1], y[check]))

    def probability(self, x: np.ndarray) -> np.ndarray:
        m = x @ self.w[:-1] + self.w[-1]
        return 1 / (1 + np.exp(-np.clip(self.slope * m + self.shift, -30, 30)))


@dataclass
class LanguageModel:
    languages: list[str]
    families: list[str] = field(default_factory=list)
    of_family: dict[str, Machine] = field(default_factory=dict)
    of_pair: dict[tuple[str, str], Machine] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> LanguageModel:
        m = cls(sorted(set(langs.tolist())))
        m.families = sorted({family(lang) for lang in m.languages})
        fam = np.array([family(lang) for lang in langs])
        if len(m.families) > 1:
            for f in m.families:
                m.of_family[f] = Machine.fit(x, np.where(fam == f, 1, -1))
        for a, b in combinations(m.languages, 2):
            if family(a) == family(b):
                rows = (langs == a) | (langs == b)
                m.of_pair[a, b] = Machine.fit(x[rows], np.where(langs[rows] == a, 1, -1))
        return m

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row."""
        share = np.ones((len(x), len(self.families)))
        for k, f in enumerate(self.families):
            if f in self.of_family:
                share[:, k] = self.of_family[f].probability(x)
        best_family = share.argmax(axis=1)
        share /= share.sum(axis=1, keepdims=True)
        out = np.empty(len(x), dtype=object)
        score = share.max(axis=1)
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(best_family == k)
            own = [lang for lang in self.languages if family(lang) == f]
            votes, belief = np.zeros((2, len(rows), len(own)))
            for (i, a), (j, b) in combinations(enumerate(own), 2):
                p = self.of_pair[a, b].probability(x[rows])
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                belief[:, i] += p
                belief[:, j] += 1 - p
            pick = (votes * 1000 + belief).argmax(axis=1) if len(rows) else rows
            out[rows] = np.array(own, dtype=object)[pick]
            if len(own) > 1:
                score[rows] *= belief[np.arange(len(rows)), pick] / (len(own) - 1)
        return out.tolist(), score


def fold(docs: DataFrame):
    """crc32 of the doc_id's text modulo FOLDS; that of a NULL doc_id is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and languages of about ``sample`` documents with a language and a fold other than 0;
    of rows that share a doc_id one is read, so no more than that many are collected."""
    rows = docs.filter(F.col("lang").isNotNull() & (fold(docs) != 0)).select("doc_id", "lang", "text")
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return np.zeros((0, FEATURES), dtype=np.float32), np.zeros(0, dtype=object)
    each = max(1, sample // len(counts))
    parts = F.lit(1_000_000)
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), parts)
    keep = F.lit(False)
    for lang, n in counts.items():
        keep = F.when(F.col("lang") == lang, draw < int(1_000_000 * min(1.0, each / n)) + 1).otherwise(keep)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [features(t or "").astype(np.float16).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), pa.array(xs, pa.binary())], ["doc_id", "lang", "x"])

    chosen = rows.filter(keep).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    seen = chosen.mapInArrow(read, "doc_id long, lang string, x binary")
    got = seen.groupBy("doc_id").agg(F.max(F.struct("x", "lang")).alias("row")).select("row.*").collect()
    got.sort(key=lambda r: (r.x, r.lang))
    x = np.stack([np.frombuffer(r.x, dtype=np.float16) for r in got]).astype(np.float32)
    mixed = np.random.Generator(np.random.PCG64(7)).permutation(len(got))
    return x[mixed], np.array([r.lang for r in got], dtype=object)[mixed]


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if shared.value and t and _LETTER.search(t)]
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                names, score[known] = shared.value.predict(np.stack([features(texts[i]) for i in known]))
                for i, name in zip(known, names):
                    lang[i] = name
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(docs) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learns from the labelled rows of ``docs`` (doc_id, text, lang) and predicts all.

    Rows whose fold is 0 are held out of learning, as are rows without a
    language.  A text that is NULL or has no letter is ``und`` with score 0;
    so is every text when nothing could be learnt.  One language alone is
    predicted with score 1.  Repeated rows are each predicted; other columns
    are not read.  An empty table stays empty.
    """
    x, langs = training_sample(docs, sample)
    return identify(docs, LanguageModel.fit(x, langs) if len(x) else None)

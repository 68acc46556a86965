"""Quality grades by ordinal cumulative-link regression (operator 4).

P(grade <= k) = sigmoid(threshold_k - w . x), with one weight vector over hashed words and a few
shape measures, and ordered thresholds.  The expected grade and the probability of the best
grade (the tail) come out for each document; documents with a tail of `min_tail` or more are kept.

Defined cases: a null or empty text has no words and gets the grade of its shape measures alone;
of several labels of one doc_id the lowest grade counts; labels without a document are ignored;
without two grades to learn from, grades are null and every document is kept; repeated rows get
equal answers; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The regression is fitted on at most so many labelled documents (smallest hashes of the id).
SAMPLE_DOCS = 12_000
BUCKET_BITS = 18
SHAPES = 8
N_FEATURES = (1 << BUCKET_BITS) + SHAPES
MIN_TAIL = 0.5
STEPS, RATE, DECAY = 120, 0.05, 1e-4
#: Beginnings of words that count besides the word, and marks that are stripped from words.
STEMS = (5, 7)
SHAPE_STEPS = (0.03, 0.06, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
MARKS = ".,;:!?()*%$#&\"'|"


class _Buckets(dict):
    """word -> the buckets of the word, its beginnings and its closing marks, remembered within
    bounds."""

    def __missing__(self, word: str) -> bytes:
        if len(self) > 300_000:
            self.clear()
        bare = word.strip(MARKS)
        parts = [bare, *("^" + bare[:n] for n in STEMS if len(bare) > n)]
        if len(word) > len(bare):
            parts.append("~" + word[len(word.rstrip(MARKS)):])
        crcs = [zlib.crc32(p.encode("utf-8", "replace")) >> (32 - BUCKET_BITS) for p in parts]
        self[word] = np.array(crcs, dtype="<i4").tobytes()
        return self[word]


_BUCKETS = _Buckets()
_STEP_BUCKETS = {(k, t, reached): zlib.crc32(f"={k}:{t}:{reached}".encode()) >> (32 - BUCKET_BITS)
                 for k in range(SHAPES) for t in SHAPE_STEPS for reached in (False, True)}


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: the hashed words and beginnings that occur, then shape measures."""
    text = text or ""
    words = text.lower().split()
    n = max(1, len(words))
    index = np.unique(np.frombuffer(b"".join(map(_BUCKETS.__getitem__, words)), dtype="<i4"))
    size = max(1, len(text))
    lines = text.split("\n")
    raw = text.encode("utf-8", "replace")
    letters = len(raw) - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    marks = len(raw) - len(raw.translate(None, b"!#$%&*+/<=>@[]^_{|}~"))
    shape = np.array([1.0 if not words else 0.0, upper / max(1, letters), digits / size * 5,
                      marks / size * 5, len(set(words)) / n, len(set(lines)) / len(lines),
                      min(2.0, sum(map(len, words)) / n / 10), np.log1p(n) / 10])
    # Each measure counts as a number and by the steps it reaches and does not reach.
    steps = [_STEP_BUCKETS[k, t, x >= t] for k, x in enumerate(shape.tolist()) for t in SHAPE_STEPS]
    index = np.union1d(index, steps)
    return (np.concatenate([index, np.arange(1 << BUCKET_BITS, N_FEATURES)]),
            np.concatenate([np.ones(len(index)), shape]).astype(np.float32))


def contrast(rows: np.ndarray, col: np.ndarray, grades: np.ndarray, n_features: int) -> np.ndarray:
    """How much the odds of a grade above a threshold change with each bucket, at the threshold
    where it does most: words that tell grades apart get large steps, the others small ones
    (the exponent widens the difference)."""
    best = np.zeros(n_features)
    for k in range(int(grades.max())):
        high = grades > k
        n_high, n_low = max(1, high.sum()), max(1, (~high).sum())
        a = np.bincount(col[high[rows]], minlength=n_features)
        b = np.bincount(col[~high[rows]], minlength=n_features)
        expect = (a + b) * n_low / (n_high + n_low)
        odds = np.log((b + 1) / (expect + 1))
        best = np.where(np.abs(odds) > np.abs(best), odds, best)
    return np.abs(best) ** 1.5


class OrdinalModel:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k (n x K-1)."""
        return 1.0 / (1.0 + np.exp(self.thresholds[None, :] - scores[:, None]))


def fit(index: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray) -> OrdinalModel:
    """Penalised maximum likelihood by Adam; thresholds stay ordered as sums of exponentials."""
    rows = np.repeat(np.arange(len(index)), [len(i) for i in index])
    col, val = np.concatenate(index), np.concatenate(values).astype(np.float64)
    used, col = np.unique(col, return_inverse=True)
    scale = np.where(used < 1 << BUCKET_BITS, contrast(rows, col, grades, len(used)), 1.0)
    val = val * scale[col]
    n, k = len(index), int(grades.max())
    share = np.array([(grades <= j).mean() for j in range(k)]).clip(1e-3, 1 - 1e-3)
    cut = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(k))
    p = np.concatenate([np.zeros(len(used)), cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    w_end = len(used)
    for step in range(1, STEPS + 1):
        w = p[:w_end]
        theta = np.cumsum(np.concatenate([p[w_end:w_end + 1], np.exp(p[w_end + 1:])]))
        score = np.bincount(rows, weights=val * w[col], minlength=n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        low, high = edges[grades] - score, edges[grades + 1] - score
        f_low, f_high = 1 / (1 + np.exp(-low)), 1 / (1 + np.exp(-high))
        mass = np.maximum(f_high - f_low, 1e-9)
        d_low, d_high = f_low * (1 - f_low), f_high * (1 - f_high)
        by_score = (d_high - d_low) / mass / n  # of minus the log-likelihood
        by_theta = np.zeros(k)
        np.add.at(by_theta, np.minimum(grades, k - 1), np.where(grades < k, -d_high / mass / n, 0))
        np.add.at(by_theta, np.maximum(grades - 1, 0), np.where(grades > 0, d_low / mass / n, 0))
        after = np.cumsum(by_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(col, weights=val * by_score[rows], minlength=w_end) + DECAY * w,
                               after[:1], after[1:] * np.exp(p[w_end + 1:])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        p = p - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(N_FEATURES, dtype=np.float32)
    weights[used] = p[:w_end] * scale
    theta = np.cumsum(np.concatenate([p[w_end:w_end + 1], np.exp(p[w_end + 1:])]))
    return OrdinalModel(weights, theta)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade: 0 toxic, 1 of low quality, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
            .filter("doc_id IS NOT NULL AND grade IS NOT NULL")
            .groupBy("doc_id").agg(F.min("grade").alias("grade")))


def train(docs: DataFrame, ratings: DataFrame, sample_docs: int = SAMPLE_DOCS) -> OrdinalModel | None:
    """Fit on a bounded sample of rated documents (`ratings`: doc_id, grade from 0)."""
    chosen = ratings.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def run(batches):
        for pdf in batches:
            both = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({"grade": pdf["grade"], "i": [a.astype(np.int32).tobytes() for a, _ in both],
                                "v": [b.tobytes() for _, b in both]})

    # At most sample_docs ids and grades: bounded, so they may be broadcast and fitted here.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id").select("text", "grade")
    got = sorted((r["grade"], bytes(r["i"]), bytes(r["v"])) for r in
                 sample.mapInPandas(run, "grade int, i binary, v binary").toLocalIterator())
    grades = np.array([g for g, _, _ in got], dtype=np.int64)
    if len(np.unique(grades)) < 2:
        return None
    return fit([np.frombuffer(i, np.int32) for _, i, _ in got],
               [np.frombuffer(v, np.float32) for _, _, v in got], grades)


def score(docs: DataFrame, model: OrdinalModel | None, min_tail: float = MIN_TAIL) -> DataFrame:
    """doc_id, expected_grade, tail_prob, kept; from the text alone."""
    def run(batches):
        for pdf in batches:
            n = len(pdf)
            if model is None:
                yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "expected_grade": [None] * n,
                                    "tail_prob": [None] * n, "kept": [True] * n})
                continue
            scores = np.empty(n)
            for k, text in enumerate(pdf["text"]):
                i, v = features(text)
                scores[k] = model.weights[i] @ v
            tails = model.tails(scores)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "expected_grade": tails.sum(axis=1),
                                "tail_prob": tails[:, -1], "kept": tails[:, -1] >= min_tail})

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInPandas(run, "doc_id long, expected_grade double, tail_prob double, kept boolean"))


def grade_documents(docs: DataFrame, labels: DataFrame, min_tail: float = MIN_TAIL) -> DataFrame:
    """Learn from rated documents that are not held out; grade all."""
    model = train(docs, graded(labels).filter(~held_out()))
    return score(docs, model, min_tail).withColumn("held_out", held_out())

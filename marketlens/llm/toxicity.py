"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a hashed n-gram of lower-cased UTF-8 bytes that a text has or has not. Its ratio is the log of how much more
often toxic texts have it than others; logistic regression learns how far to trust each ratio. Texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_bytes, mixed, pieces

#: Lengths of the n-grams in bytes.
GRAMS = (3, 4, 5)
#: Hash buckets of the features.
BUCKETS = 1 << 18
#: Labelled rows of each class that the fit looks at, chosen by a hash of the id. Scoring knows no such bound.
FIT_ROWS = 2_000
#: Features of those rows at most that are kept for the fit: rows are taken by turns from the classes while both have some,
#: and the row whose features pass it is the last one.
FIT_FEATURES = 24_000_000
#: A ratio that is not this many standard errors from none counts as none: it is chance, and long texts have much of it.
LEAST_ERRORS = 3.0
SMOOTHING = 1.0
RIDGE = 1e-3
STEPS = 120

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(text: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The distinct features of one text's bytes. `seen` is scratch of BUCKETS entries."""
    if not len(text):
        return np.zeros(0, np.int64)
    low = _LOWER[text].astype(np.uint64)
    found = []
    packed = low
    for n in range(2, max(GRAMS) + 1):
        if len(low) < n:
            break
        packed = (packed[: len(low) - n + 1] << np.uint64(8)) | low[n - 1 :]
        if n in GRAMS:
            found.append(mixed(packed | np.uint64(n) << np.uint64(56)))
    if not found:
        return np.zeros(0, np.int64)
    at = (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64)
    order = np.arange(len(at), dtype=np.int32)
    seen[at] = order  # the last one stays
    return at[seen[at] == order]


def distinct_grams(texts: pa.Array) -> Iterator[np.ndarray]:
    data, begin = as_bytes(texts)
    seen = np.zeros(BUCKETS, np.int32)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        yield grams(data[a:b], seen)


@dataclass
class Model:
    """Weights by bucket and an intercept; the size is that of BUCKETS."""

    weights: np.ndarray
    intercept: float

    def score(self, features: np.ndarray) -> float:
        z = float(self.weights[features].sum(dtype=np.float64)) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def fit(rows: list[np.ndarray], labels: np.ndarray, prior: float) -> Model:
    """Log-count ratios of the rows and a ridge logistic regression over them.

    `prior` is the share of label 1 among all labelled rows; the intercept is moved from the share among these to it.
    Without rows of both classes every score is the prior.
    """
    flat = np.zeros(BUCKETS)
    odds = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    if not len(labels) or labels.min() == labels.max():
        return Model(flat, float(odds))
    y = labels.astype(np.float64)
    toxic, every = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for x, label in zip(rows, y, strict=True):  # a row has a feature once
        every[x] += 1
        toxic[x] += label
    p, q = toxic + SMOOTHING, every - toxic + SMOOTHING
    ratio = np.log(p / (y.sum() + SMOOTHING)) - np.log(q / ((1 - y).sum() + SMOOTHING))
    ratio[np.abs(ratio) < LEAST_ERRORS * np.sqrt(1 / p + 1 / q)] = 0
    rows = [x[ratio[x] != 0] for x in rows]
    feature = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    value = ratio[feature]

    # full-batch Adam; the curvature of the scaled features differs by orders of magnitude
    w, b = np.zeros(BUCKETS), 0.0
    m, v = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    rate = 0.05
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[feature] * value, len(rows)) + b
        miss = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y
        slope = np.bincount(feature, miss[row] * value, BUCKETS) / len(rows) + RIDGE * w
        g = np.append(slope, miss.mean())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w -= move[:-1]
        b -= move[-1]
    shift = odds - np.log(y.mean() / (1 - y.mean()))
    return Model((w * ratio).astype(np.float32), float(b + shift))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on up to FIT_ROWS labelled rows of each class for which `allowed` (over the id) holds.

    Which rows is settled by a hash of their ids. Rows without id or label and ids that have both labels teach nothing; an
    id that is labelled more than once alike counts once, and so does an id with several texts: the one whose features
    come first. The features of the chosen rows are found in tasks.
    """
    known = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & allowed)
        .groupBy(doc_id)
        .agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .filter("low = high")
    )
    counts = {r["low"]: r["n"] for r in known.groupBy("low").agg(F.count("*").alias("n")).collect()}
    picked = [
        known.filter(F.col("low") == k).orderBy(F.xxhash64(doc_id), doc_id).limit(FIT_ROWS) for k in (0, 1)
    ]
    turn = F.row_number().over(Window.partitionBy("low").orderBy(F.xxhash64(doc_id), doc_id))  # of FIT_ROWS rows
    chosen = picked[0].unionByName(picked[1]).select(F.col(doc_id).alias("chosen_id"), F.col("low").alias("chosen_label"), turn.alias("turn"))
    some = docs.select(F.col(doc_id).alias("chosen_id"), F.col(text).alias("chosen_text")).join(
        F.broadcast(chosen), "chosen_id"  # 2 * FIT_ROWS ids at most
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "chosen_text"):
                found = [x.astype(np.uint32).tobytes() for x in distinct_grams(part.column("chosen_text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("chosen_id").cast(pa.string()), part.column("chosen_label").cast(pa.int32()), part.column("turn"), pa.array(found, pa.binary())],
                    names=["id", "label", "turn", "features"],
                )

    got, y, total = [], [], 0
    found = some.mapInArrow(rows, "id string, label int, turn int, features binary")
    found = found.groupBy("turn", "label", "id").agg(F.min("features").alias("features"))  # one row for each id
    taken = found.orderBy("turn", "label", "id")
    for r in taken.toLocalIterator():
        x = np.frombuffer(r["features"], np.uint32)
        got.append(x)
        y.append(r["label"])
        total += len(x)
        if total > FIT_FEATURES:
            break
    n = sum(counts.values())
    return fit(got, np.array(y), counts.get(1, 0) / n if n else 0.0)


def score_documents(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Each row with its probability of label 1.

    Null and empty texts and texts shorter than an n-gram have no feature and get the intercept's probability. Repeated
    rows and equal texts get equal scores. A column that is named like the score gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))  # BUCKETS floats
    kept = [c for c in docs.columns if c.lower() != score.lower()]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(score, T.DoubleType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model(*shared.value)
        for batch in batches:
            for part in pieces(batch, text):
                scores = [scorer.score(x) for x in distinct_grams(part.column(text))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(scores, pa.float64())], names=[*kept, score])

    return docs.select(kept).mapInArrow(rows, schema)

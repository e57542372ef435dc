"""Quality: a linear-chain conditional random field marks every line good or bad.

A line is described by bins of counts and shares of its bytes and words, and by the same bins of the line before and after
it. Forward and backward sums give each line's marginal probability of being good; their mean, weighted by line length, is
a document's, and a logistic curve fitted on labelled documents turns that into a score.

Only documents have labels. In the fit every line bears its document's label; the chain learns which lines are found in
good documents only, in bad ones only, or in both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_bytes, mixed, pieces

#: Labelled documents of each class that the fit looks at, chosen by a hash of the id, and the lines that it takes of each
#: in a chain of at most so many lines: stretches of lines, evenly spaced over the text. Scoring knows no such bounds.
FIT_ROWS, FIT_LINES, STRETCHES = 2_000, 200, 8
STEPS, RATE, RIDGE = 120, 0.08, 1e-3

_SPACE = np.zeros(256, np.uint8)
_SPACE[[9, 11, 12, 13, 32]] = 1
_KINDS = {
    "upper": [range(65, 91)],
    "digit": [range(48, 58)],
    "stop": [(ord(c),) for c in ".,;:'\"()-"],
    "shout": [(ord(c),) for c in "!?"],
    "sign": [(ord(c),) for c in "#$%&*+/<=>@[\\]^_`{|}~"],
    "high": [range(128, 256)],
}
_CLASSES = []
for _ranges in _KINDS.values():
    _is = np.zeros(256, np.uint8)
    for _r in _ranges:
        _is[list(_r)] = 1
    _CLASSES.append(_is)
_SHARES = np.array([1e-9, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6])
_LENGTHS = np.array([1, 10, 30, 80, 200, 500, 1500, 5000])
_WORD_LENGTHS = np.array([1, 2, 3, 4, 5.5, 7, 9, 14])
#: One bin more than bounds; all features have as many.
BINS = len(_SHARES) + 1
FEATURES = len(_CLASSES) + 6


def line_bins(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of each line (line, feature), bytes of each line, and lines of each text. Lines end at line feeds; a text has
    a line after its last line feed unless that is empty. An empty text has no line."""
    n_docs = len(begin) - 1
    if not len(data):
        return np.zeros((0, FEATURES), np.int64), np.zeros(0, np.int64), np.zeros(n_docs, np.int64)
    ends = np.union1d(np.flatnonzero(data == 10) + 1, begin[1:][np.diff(begin) > 0])
    start = np.concatenate([[0], ends[:-1]])
    size = ends - start
    lines = np.bincount(np.searchsorted(begin, start, "right") - 1, minlength=n_docs)

    share = [np.add.reduceat(c[data], start, dtype=np.int64) / size for c in _CLASSES]
    blank = _SPACE[data] | (data == 10)
    first = np.flatnonzero((blank == 0) & np.concatenate([[1], blank[:-1]]).astype(bool))  # of each word
    line_start = np.zeros(len(data), bool)
    line_start[start] = True
    first = np.union1d(first, start[blank[start] == 0])  # a text may begin without a space before it
    words = np.bincount(np.searchsorted(start, first, "right") - 1, minlength=len(start))
    inked = size - np.add.reduceat(blank, start, dtype=np.int64)
    word_length = inked / np.maximum(words, 1)

    # words that equal the one before them, and lines that the same text has more than once
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
        at = np.arange(len(data)) - np.repeat(start, size)
        token = mixed(data.astype(np.uint64) + np.uint64(1)) * power[at & 63]
        line_hash = np.add.reduceat(token, start)
        if len(first):
            owner = np.searchsorted(start, first, "right") - 1
            in_word = np.arange(len(data)) - np.repeat(np.concatenate([[0], first]), np.diff(np.concatenate([[0], first, [len(data)]])))
            letter = mixed(data.astype(np.uint64) + np.uint64(1)) * power[in_word & 63] * (blank == 0)
            word_hash = np.add.reduceat(letter, first)
            same = np.concatenate([[False], (word_hash[1:] == word_hash[:-1]) & (owner[1:] == owner[:-1])])
            stutter = np.bincount(owner[same], minlength=len(start)) / np.maximum(words, 1)
        else:
            stutter = np.zeros(len(start))
        doc = np.repeat(np.arange(n_docs), lines).astype(np.uint64)
        _, inverse, times = np.unique(mixed(line_hash) ^ mixed(doc), return_inverse=True, return_counts=True)
    repeats = np.minimum(times[inverse], BINS) - 1

    bins = [np.searchsorted(_SHARES, s, "right") for s in share]
    bins.append(np.searchsorted(_LENGTHS, size, "right"))
    bins.append(np.searchsorted(_WORD_LENGTHS, word_length, "right"))
    bins.append(np.searchsorted(_SHARES, stutter, "right"))
    bins.append(repeats)
    bins.append(np.minimum(words, BINS - 1))
    bins.append((share[0] * size > 0.6 * inked).astype(np.int64) + 2 * (share[4] * size > words))
    return np.minimum(np.stack(bins, axis=1), BINS - 1), size, lines


@dataclass
class Chain:
    """Weights of the bins of a line itself, of the line before and the line after (all towards "good"), a bias, the
    transitions between bad and good, and the curve from a document's mean to its score."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    bias: float
    moves: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def emissions(self, bins: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Score of "good" against "bad" of each line."""
        column = np.arange(FEATURES)
        out = self.own[column, bins].sum(axis=1) + self.bias
        first = np.zeros(len(bins), bool)
        starts = np.concatenate([[0], np.cumsum(lines)])[:-1][lines > 0]
        first[starts] = True
        inner = np.flatnonzero(~first)
        out[inner] += self.before[column, bins[inner - 1]].sum(axis=1)
        out[inner - 1] += self.after[column, bins[inner]].sum(axis=1)
        return out

    def marginals(self, emission: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability that a line is good, and for each line but the first of a text the joint probabilities (2 x 2) of
        the line before and itself. Texts go side by side, longest first, one line at a time."""
        n = len(emission)
        good, pair = np.zeros(n), np.zeros((n, 2, 2))
        if not n:
            return good, pair
        start = np.concatenate([[0], np.cumsum(lines)])[:-1]
        order = np.argsort(-lines, kind="stable")
        order = order[lines[order] > 0]
        length, start = lines[order], start[order]
        move = np.exp(self.moves)
        local = np.stack([np.ones(n), np.exp(np.clip(emission, -30, 30))], axis=1)
        forward, backward = np.zeros((n, 2)), np.ones((n, 2))
        many = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length[0]) + 1)]  # longer than t
        for t in range(int(length[0])):
            at = start[: many[t]] + t
            now = local[at] * (forward[at - 1] @ move if t else 1.0)
            forward[at] = now / now.sum(axis=1, keepdims=True)
        for t in range(int(length[0]) - 2, -1, -1):
            at = start[: many[t + 1]] + t
            now = (local[at + 1] * backward[at + 1]) @ move.T
            backward[at] = now / now.sum(axis=1, keepdims=True)
        both = forward * backward
        good = both[:, 1] / both.sum(axis=1)
        inner = np.ones(n, bool)
        inner[start] = False
        inner = np.flatnonzero(inner)
        pair[inner] = forward[inner - 1][:, :, None] * move * (local[inner] * backward[inner])[:, None, :]
        pair[inner] /= np.maximum(pair[inner].sum(axis=(1, 2), keepdims=True), 1e-300)
        return good, pair

    def mean_good(self, bins: np.ndarray, size: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Mean of the marginals of each text's lines, weighted by bytes; 0.5 for a text without lines."""
        good, _ = self.marginals(self.emissions(bins, lines), lines)
        owner = np.repeat(np.arange(len(lines)), lines)
        weight = np.bincount(owner, size, len(lines))
        return np.where(weight > 0, np.bincount(owner, good * size, len(lines)) / np.maximum(weight, 1), 0.5)

    def scores(self, mean: np.ndarray) -> np.ndarray:
        m = np.clip(mean, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(m / (1 - m)) + self.offset, -60, 60)))


def fit(bins: np.ndarray, size: np.ndarray, lines: np.ndarray, labels: np.ndarray, prior: float) -> Chain:
    """Maximum likelihood of the labels of all lines with a small ridge, by full-batch Adam; then the curve.

    `prior` is the share of label 1 among all labelled documents. Without documents of both classes all scores are it.
    """
    odds = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    zero = np.zeros((FEATURES, BINS))
    chain = Chain(zero.copy(), zero.copy(), zero.copy(), 0.0, np.zeros((2, 2)), 0.0, odds)
    if not len(labels) or labels.min() == labels.max() or not len(bins):
        return chain
    y = np.repeat(labels, lines).astype(np.float64)
    first = np.zeros(len(bins), bool)
    first[np.concatenate([[0], np.cumsum(lines)])[:-1][lines > 0]] = True
    inner = np.flatnonzero(~first)
    code = bins + np.arange(FEATURES) * BINS
    width = FEATURES * BINS
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1].astype(int), y[inner].astype(int)), 1)
    weights = np.zeros(3 * width + 5)
    m, v = np.zeros_like(weights), np.zeros_like(weights)

    def unpack() -> None:
        chain.own, chain.before, chain.after = (weights[i * width : (i + 1) * width].reshape(FEATURES, BINS) for i in range(3))
        chain.bias, chain.moves = float(weights[3 * width]), weights[3 * width + 1 :].reshape(2, 2)

    for step in range(1, STEPS + 1):
        unpack()
        good, pair = chain.marginals(chain.emissions(bins, lines), lines)
        miss = good - y
        count = lambda at, of: np.bincount(code[at].ravel(), np.repeat(miss[of], FEATURES), width)
        every = np.arange(len(bins))
        g = np.concatenate(
            [count(every, every), count(inner - 1, inner), count(inner, inner - 1), [miss.sum()], (pair.sum(axis=0) - seen).ravel()]
        )
        g = g / len(bins) + RIDGE * weights
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    unpack()

    mean = np.clip(chain.mean_good(bins, size, lines), 1e-6, 1 - 1e-6)
    x = np.stack([np.log(mean / (1 - mean)), np.ones(len(mean))], axis=1)
    share = labels.mean()
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))  # the classes as frequent as they are
    curve = np.zeros(2)
    for _ in range(30):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + 1e-2 * curve
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        curve -= np.linalg.solve(bend, slope)
    chain.slope, chain.offset = float(curve[0]), float(curve[1])
    return chain


def spread(n: int) -> np.ndarray:
    """Which of n lines the fit takes: all up to FIT_LINES, else STRETCHES of them from the first line to the last."""
    if n <= FIT_LINES:
        return np.arange(n)
    long = FIT_LINES // STRETCHES
    begin = np.linspace(0, n - long, STRETCHES).astype(np.int64)
    return (begin[:, None] + np.arange(long)).ravel()


def train(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Chain:
    """Fit on up to FIT_ROWS labelled documents of each class for which `allowed` (over the id) holds.

    Which documents is settled by a hash of their ids. Rows without id or label and ids that have both labels teach
    nothing; an id that is labelled more than once alike counts once, and of several rows with one id one teaches. Lines are
    described in tasks.
    """
    known = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & allowed)
        .groupBy(doc_id)
        .agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .filter("low = high")
    )
    counts = {r["low"]: r["n"] for r in known.groupBy("low").agg(F.count("*").alias("n")).collect()}
    picked = [known.filter(F.col("low") == k).orderBy(F.xxhash64(doc_id), doc_id).limit(FIT_ROWS) for k in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).select(F.col(doc_id).alias("chosen_id"), F.col("low").alias("chosen_label"))
    some = docs.select(F.col(doc_id).alias("chosen_id"), F.col(text).alias("chosen_text")).join(
        F.broadcast(chosen), "chosen_id"  # 2 * FIT_ROWS ids at most
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "chosen_text"):
                bins, size, lines = line_bins(*as_bytes(part.column("chosen_text")))
                ends = np.cumsum(lines)
                spans = [e - k + spread(k) for e, k in zip(ends.tolist(), lines.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("chosen_id").cast(pa.string()),
                        part.column("chosen_label").cast(pa.int32()),
                        pa.array([bins[s].astype(np.uint8).tobytes() for s in spans], pa.binary()),
                        pa.array([size[s].astype(np.int64).tobytes() for s in spans], pa.binary()),
                    ],
                    names=["id", "label", "bins", "size"],
                )

    lines_of = some.mapInArrow(rows, "id string, label int, bins binary, size binary").filter(F.length("size") > 0)
    one = F.min(F.struct(F.xxhash64("size", "bins"), "size", "bins")).alias("one")  # reduced in tasks first
    taken = lines_of.groupBy("id", "label").agg(one).select("id", "label", "one.size", "one.bins").collect()
    taken.sort(key=lambda r: r["id"])
    n = sum(counts.values())
    prior = counts.get(1, 0) / n if n else 0.5
    none = np.zeros(0, np.int64)
    bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(-1, FEATURES) for r in taken] or [np.zeros((0, FEATURES), np.uint8)])
    sizes = [np.frombuffer(r["size"], np.int64) for r in taken]
    lines = np.array([len(s) for s in sizes], np.int64)
    return fit(bins.astype(np.int64), np.concatenate(sizes or [none]), lines, np.array([r["label"] for r in taken], np.int64), prior)


def score_documents(docs: DataFrame, chain: Chain, text: str = "text", score: str = "score") -> DataFrame:
    """Each row with its probability of label 1.

    Null and empty texts have no lines and get the curve's value for even odds. Every line of a text counts, however many.
    Equal texts get equal scores. A column that is named like the score gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain.__dict__)  # some hundred weights
    kept = [c for c in docs.columns if c.lower() != score.lower()]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(score, T.DoubleType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Chain(**shared.value)
        for batch in batches:
            for part in pieces(batch, text):
                mean = scorer.mean_good(*line_bins(*as_bytes(part.column(text))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(scorer.scores(mean), pa.float64())], names=[*kept, score]
                )

    return docs.select(kept).mapInArrow(rows, schema)

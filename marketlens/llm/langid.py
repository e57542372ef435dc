"""Language ID: a byte convolutional network, trained and applied in numpy.

Bytes get vectors, filters of several widths run over a window of WINDOW bytes, each filter keeps its maximum, and a
softmax over the maxima gives the window's languages. A document's answer is the mean over all its windows, each weighted
by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_bytes, pieces

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
VECTOR = 6
#: Documents of a language that the fit looks at, chosen by a hash of the id, and windows of each, evenly spaced.
#: Prediction knows no such bounds.
FIT_ROWS, FIT_WINDOWS = 300, 6
#: Documents that the fit looks at in all, shared out evenly, but one of each language at least.
FIT_ALL = 30_000
EPOCHS, BATCH, RATE = 10, 128, 4e-3
#: Windows that are looked at together.
TOGETHER = 512

UNDETERMINED = "und"
#: ASCII capitals count as small letters; byte 0 stands for what lies beyond the text.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_LETTER = regex.compile(r"\p{L}")


class ByteNet:
    """Parameters: byte vectors, filters of all widths as one matrix, and the last layer. A narrow filter has zeros in
    the rows of the bytes that it does not see."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        reach, n = max(WIDTHS), FILTERS * len(WIDTHS)
        self.languages = languages
        self.mask = np.zeros((reach, VECTOR, n), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(reach * VECTOR, n)
        self.vectors = rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
        self.filters = (rng.normal(0, 0.4, self.mask.shape) * self.mask).astype(np.float32)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.2, (n, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """Vectors of the bytes under each filter position."""
        reach = max(WIDTHS)
        x = self.vectors[windows]
        n, length, _ = x.shape
        view = np.lib.stride_tricks.sliding_window_view(x.reshape(n, -1), reach * VECTOR, axis=1)[:, ::VECTOR]
        return view.reshape(n * (length - reach + 1), reach * VECTOR)

    def pooled(self, windows: np.ndarray, where: bool = False):
        patches = self.patches(windows)
        y = (patches @ self.filters).reshape(len(windows), -1, self.filters.shape[1])
        top = np.maximum(y.max(axis=1) + self.bias, 0)
        return (top, y.argmax(axis=1), patches) if where else top

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows) @ self.out + self.out_bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def slopes(self, windows: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy, in the order of `parameters`."""
        n, reach = len(windows), max(WIDTHS)
        top, at, patches = self.pooled(windows, where=True)
        z = top @ self.out + self.out_bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        d = e / e.sum(axis=1, keepdims=True)
        d[np.arange(n), y] -= 1
        d /= n
        back = (d @ self.out.T) * (top > 0)  # to the one position of each filter that counted
        positions = windows.shape[1] - reach + 1
        chosen = patches.reshape(n, positions, -1)[np.arange(n)[:, None], at]  # window, filter, patch
        filters = np.einsum("nf,nfp->pf", back, chosen, optimize=True) * self.mask
        into = (back[:, :, None] * self.filters.T[None]).reshape(n, -1, reach, VECTOR)
        seen = windows[np.arange(n)[:, None, None], at[:, :, None] + np.arange(reach)]
        vectors = np.stack([np.bincount(seen.ravel(), into[..., k].ravel(), 256) for k in range(VECTOR)], axis=1)
        return [vectors, filters, back.sum(axis=0), top.T @ d, d.sum(axis=0)]

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.out, self.out_bias]

    def fit(self, windows: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        moments = [(np.zeros(p.shape), np.zeros(p.shape)) for p in self.parameters()]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for a in range(0, len(y), BATCH):
                step += 1
                some = order[a : a + BATCH]
                for p, g, (m, v) in zip(self.parameters(), self.slopes(windows[some], y[some]), moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


def cut_windows(text: np.ndarray) -> np.ndarray:
    """The whole text as rows of WINDOW bytes, the last one filled up with zeros."""
    rows = -(-len(text) // WINDOW)
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(text)] = _LOWER[text]
    return out.reshape(rows, WINDOW)


def has_letter(text: np.ndarray) -> bool:
    if _LETTERS[text[:64]].any() or _LETTERS[text].any():
        return True
    return bool((text >= 128).any()) and bool(_LETTER.search(text.tobytes().decode("utf-8", "replace")))


def train(docs: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteNet:
    """Fit on up to FIT_ROWS documents of each language for which `allowed` holds, FIT_ALL at most together if there are
    no more languages than that: each language has the same number then, one at least. Rows without language or text
    teach nothing. An id is one document: if it is repeated, the row of the least language and windows stands for it. The
    windows of the chosen documents are cut in tasks. Without any the net knows no language."""
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    named = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & allowed)
    known = named.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang")).groupBy("id").agg(F.min("lang").alias("lang"))
    each = min(FIT_ROWS, max(1, FIT_ALL // max(1, known.select("lang").distinct().count())))
    chosen = known.withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= each).select("id", "lang")
    some = named.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).join(
        F.broadcast(chosen), ["id", "lang"]  # FIT_ALL rows, or one for each language
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, begin = as_bytes(part.column("text"))
                found = []
                for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
                    cut = cut_windows(data[a:b]) if has_letter(data[a:b]) else np.zeros((0, WINDOW), np.uint8)
                    at = np.unique(np.linspace(0, max(len(cut) - 1, 0), min(FIT_WINDOWS, len(cut))).astype(int))
                    found.append(cut[at].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").cast(pa.string()), part.column("lang"), pa.array(found, pa.binary())], names=["id", "lang", "windows"]
                )

    windows = some.mapInArrow(rows, "id string, lang string, windows binary").groupBy("id").agg(F.min("lang").alias("lang"), F.min("windows").alias("windows"))
    taken = sorted(windows.collect(), key=lambda r: (r["lang"], r["id"], r["windows"]))
    languages = sorted({r["lang"] for r in taken})
    net = ByteNet(languages)
    cuts = [np.frombuffer(r["windows"], np.uint8).reshape(-1, WINDOW) for r in taken]
    if cuts and sum(map(len, cuts)):
        net.fit(np.concatenate(cuts), np.repeat([languages.index(r["lang"]) for r in taken], [len(c) for c in cuts]))
    return net


def predict(docs: DataFrame, net: ByteNet, text: str = "text") -> DataFrame:
    """Each row with `lang_pred` and `score`, the language's mean probability.

    Null texts and texts without any letter get `und` and score 0, as does everything if no language was learnt. Very long
    texts are read window by window to their end. Equal texts get equal answers; equal probabilities go to the language
    that sorts first. Columns that are named like the added ones give way to them.
    """
    shared = docs.sparkSession.sparkContext.broadcast([net.languages, *net.parameters()])  # some thousand floats
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    schema = T.StructType(
        [docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, *parameters = shared.value
        model = ByteNet(languages)
        model.vectors, model.filters, model.bias, model.out, model.out_bias = parameters
        for batch in batches:
            for part in pieces(batch, text):
                data, begin = as_bytes(part.column(text))
                n = part.num_rows
                total = np.zeros((n, max(len(languages), 1)))
                size = np.diff(begin)
                spans = list(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))
                lettered = np.array([bool(languages) and has_letter(data[a:b]) for a, b in spans], bool)
                owners = np.flatnonzero(lettered)
                if len(owners):
                    cuts = np.concatenate([cut_windows(data[spans[i][0] : spans[i][1]]) for i in owners])
                    count = -(-size[owners] // WINDOW)
                    owner = np.repeat(owners, count)
                    weight = np.full(len(owner), float(WINDOW))
                    weight[np.cumsum(count) - 1] = size[owners] - (count - 1) * WINDOW
                    for a in range(0, len(cuts), TOGETHER):
                        at = slice(a, a + TOGETHER)
                        np.add.at(total, owner[at], model.probabilities(cuts[at]) * weight[at, None])
                best = total.argmax(axis=1)
                score = total[np.arange(n), best] / np.maximum(size, 1)
                names = [languages[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
                new = [pa.array(names, pa.string()), pa.array(np.where(lettered, np.clip(score, 0, 1), 0.0), pa.float64())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + new, names=[*kept, "lang_pred", "score"])

    return docs.select(kept).mapInArrow(rows, schema)

"""Bigram scores from a log-frequency Bloom filter.

All words and word pairs of the training texts are counted. A count c is kept as the level 1 + floor(log2 c): the n-gram
goes into the filter once with each level up to its own. Reading a count is a series of membership probes that ends at the
first level that is not there, so a false positive can only raise a count, and ever less likely by more. Probabilities
are bigram estimates mixed with unigram ones.

The filter is made of segments, one for each range of hashes, and has BITS for each level of every n-gram, so it grows with
the texts. Up to FILTER_BYTES it is sent to every worker. A larger one stays where it is counted: pieces of text send the
n-grams they hold to the tasks that have the segments, and the levels come back to the piece. Scores are the same either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_bytes, mixed, pieces, stored
from .words import pair_hash, word_hashes

#: Size up to which the filter is sent to every worker, its bits for each level of an n-gram, and the probes of a level.
FILTER_BYTES, BITS, PROBES = 1 << 20, 10, 4
#: Share of the bigram estimate in a probability; none after a word that the filter does not hold.
PAIR_SHARE = 0.3
#: Words whose exact counts are sent to every worker; counts of the others are joined.
FREQUENT = 1 << 18
#: Text that is counted together, and input text for each range of hashes.
TOGETHER, RANGE_BYTES = 4 << 20, 8 << 20
#: Stand for the borders of a text.
BEGIN, END = np.uint64(0xB5AD4ECEDA1CE2A9), np.uint64(0x243F6A8885A308D3)


def token_hashes(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts (words, then an end), the hash of each with the token before it, and tokens of each text."""
    words, count = word_hashes(data, begin)
    n = count + 1
    stop = np.cumsum(n)
    tokens = np.full(int(n.sum()), END, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[stop - 1] = False
    tokens[inner] = words
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[stop - n] = BEGIN
    return tokens, pair_hash(before, tokens), n


def ranges_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of n ranges each hash falls into."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that have a level; none for level 0."""
    top = np.exp2(levels)
    return np.where(levels > 0, (top / 2 + top - 1) / 2, 0.0)


def probes(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and stride of the probes of each n-gram at a level."""
    with np.errstate(over="ignore"):
        h = mixed(hashes + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
    return h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)


def bit(start: np.ndarray, stride: np.ndarray, k: int, size: np.ndarray | np.uint64) -> np.ndarray:
    """Where the k-th probe falls in a segment of so many bits (fewer than 2^32)."""
    return (((start + np.uint64(k) * stride) & np.uint64(0xFFFFFFFF)) * size >> np.uint64(32)).astype(np.int64)


def segment(hashes: np.ndarray, levels: np.ndarray) -> bytes:
    """The filter's bits for the n-grams of one range."""
    size = max(1, -(-int(levels.sum()) * BITS // 8)) * 8
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        start, stride = probes(hashes[levels >= level], level)
        for k in range(PROBES):
            bits[bit(start, stride, k, np.uint64(size))] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """The segments in a row; a level is read by a series of probes."""

    def __init__(self, bits: bytes, sizes: np.ndarray):
        self.bits = np.frombuffer(bits, np.uint8)
        self.size = sizes.astype(np.uint64) * np.uint64(8)
        self.begin = (np.cumsum(sizes) - sizes).astype(np.int64) * 8

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        if not len(self.size):
            return out
        owner = ranges_of(hashes, len(self.size))
        size, begin = self.size[owner], self.begin[owner]
        left, level = np.arange(len(hashes)), 0
        while len(left):
            out[left] = level
            level += 1
            start, stride = probes(hashes[left], level)
            for k in range(PROBES):
                at = bit(start, stride, k, size[left]) + begin[left]
                hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                left, start, stride = left[hit], start[hit], stride[hit]
        return out


def count_ngrams(texts: DataFrame, n_ranges: int) -> DataFrame:
    """For each range of hashes the exact counts of its tokens, as packed arrays, and the filter's segment: the bits of its
    tokens and pairs, all of which are counted. Pairs are needed for nothing else, so their counts end there. Tasks count what
    they hold before anything is shuffled, so a frequent word is one entry of a task, and ranges are even whatever the words."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", TOGETHER):
                tokens, pairs, _ = token_hashes(*as_bytes(part.column("text")))
                for order, hashes in ((1, tokens), (2, pairs)):
                    found, times = np.unique(hashes, return_counts=True)
                    stops = np.searchsorted(ranges_of(found, n_ranges), np.arange(n_ranges + 1))
                    spans = [(i, a, b) for i, (a, b) in enumerate(zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)) if b > a]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i for i, _, _ in spans], pa.int32()),
                            pa.array([order] * len(spans), pa.int32()),
                            pa.array([found[a:b].tobytes() for _, a, b in spans], pa.binary()),
                            pa.array([times[a:b].astype(np.int32).tobytes() for _, a, b in spans], pa.binary()),
                        ],
                        names=["range", "order", "hashes", "counts"],
                    )

    def add_up(group: pa.Table) -> pa.Table:
        order, every = group["order"].to_numpy(), []
        for k in (1, 2):
            rows = group.filter(pa.array(order == k))
            hashes, counts = unpacked(rows["hashes"], np.uint64), unpacked(rows["counts"], np.int32)
            found, inverse = np.unique(hashes, return_inverse=True)
            every.append((found, np.bincount(inverse, counts, len(found)).astype(np.int64)))
        words, times = every[0]
        levels = levels_of(np.concatenate([n for _, n in every]))
        return pa.table(
            {
                "range": group["range"].slice(0, 1),
                "hashes": pa.array([words.tobytes()], pa.binary()),
                "counts": pa.array([times.tobytes()], pa.binary()),
                "tokens": [int(times.sum())],
                "distinct": [len(words)],
                "by_level": pa.array([np.bincount(levels, minlength=64).tolist()], pa.list_(pa.int64())),
                "bits": pa.array([segment(np.concatenate([h for h, _ in every]), levels)], pa.binary()),
            }
        )

    packed = texts.mapInArrow(pack, "range int, order int, hashes binary, counts binary")
    return packed.groupBy("range").applyInArrow(
        add_up, "range int, hashes binary, counts binary, tokens long, distinct long, by_level array<long>, bits binary"
    )


def lowest_level(by_level: np.ndarray) -> int:
    """The lowest level whose n-grams still fit into FILTER_BYTES together with all higher ones: 1 if the whole filter does."""
    weight = by_level * np.arange(len(by_level)) * BITS
    fits = np.cumsum(weight[::-1])[::-1] <= FILTER_BYTES * 8
    return max(1, int(np.argmax(fits)))


def unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in column.to_pylist())])


def fill_filter(counted: DataFrame, n_ranges: int) -> tuple[bytes, np.ndarray]:
    """The filter's bits and the bytes of each segment."""

    rows = counted.select("range", "bits").collect()
    bits = {r["range"]: r["bits"] for r in rows}
    parts = [bytes(bits.get(i, b"\0")) for i in range(n_ranges)]
    return b"".join(parts), np.array([len(x) for x in parts], np.int64)


def numbered_pieces(docs: DataFrame, text: str) -> DataFrame:
    """The rows with the number of the piece of text they are in, the same each time they are read."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for k, part in enumerate(part for batch in batches for part in pieces(batch, text, TOGETHER)):
            piece = pa.array(np.full(part.num_rows, first + k))
            yield pa.RecordBatch.from_arrays([*part.columns, piece], names=[*part.schema.names, "__piece"])

    return stored(docs.mapInArrow(number, T.StructType([*docs.schema, T.StructField("__piece", T.LongType())])), "zstd")


def levels_of_pieces(held: DataFrame, text: str, counted: DataFrame, n_ranges: int) -> DataFrame:
    """(__piece, range, levels): what the filter says of the n-grams of each piece, in the order of their hashes, read where
    its segments are."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = batch.column("__piece").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                tokens, pairs, _ = token_hashes(*as_bytes(batch.slice(a, b - a).column(text)))
                found = np.unique(np.concatenate([tokens, pairs]))
                stops = np.searchsorted(ranges_of(found, n_ranges), np.arange(n_ranges + 1)).tolist()
                spans = [(i, x, y) for i, (x, y) in enumerate(zip(stops[:-1], stops[1:], strict=True)) if y > x]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(piece[a])] * len(spans), pa.int64()),
                        pa.array([i for i, _, _ in spans], pa.int32()),
                        pa.array([found[x:y].tobytes() for _, x, y in spans], pa.binary()),
                    ],
                    names=["__piece", "range", "hashes"],
                )

    def answer(grams: pa.Table, asked: pa.Table) -> pa.Table:
        bits = grams["bits"][0].as_py() if grams.num_rows else b"\0"
        bloom = Filter(bits, np.array([len(bits)]))
        levels = [bloom.levels(np.frombuffer(x, np.uint64)).astype(np.uint8).tobytes() for x in asked["hashes"].to_pylist()]
        return pa.table({"__piece": asked["__piece"], "range": asked["range"], "levels": pa.array(levels, pa.binary())})

    asked = held.select("__piece", text).mapInArrow(ask, "__piece long, range int, hashes binary")
    return (
        counted.select("range", "bits")
        .groupBy("range")
        .cogroup(asked.groupBy("range"))
        .applyInArrow(answer, "__piece long, range int, levels binary")
    )


def frequent_words(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and exact counts of the FREQUENT most frequent words."""
    words = counted.select("hashes", "counts").mapInArrow(_unpacked, "hash long, n long")
    top = words.orderBy(F.col("n").desc(), "hash").limit(FREQUENT).toArrow()
    hashes = top["hash"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top["n"].to_numpy()[order]


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for hashes, counts in zip(batch.column("hashes"), batch.column("counts"), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(hashes.as_py(), np.int64)), pa.array(np.frombuffer(counts.as_py(), np.int64))], names=["hash", "n"]
            )


def score_documents(docs: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """Each row, without its text, with n_tokens, n_known, train_tokens, base_score and score.

    `training` says which rows teach the model. Null texts are empty: their only token is the end. Every token of a text
    counts. With nothing to learn from, no token is known and all have probability 1. Equal texts get equal scores;
    repeated rows teach as often as they stand. Columns that are named like the added ones give way to them.

    base_score adds up log10((c + 1) / (N + V + 1)) with exact counts c; score adds up the log10 probabilities of the
    filter's model. Counts of words that are not FREQUENT are joined by hash.
    """
    added = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [f.name for f in T.StructType.fromDDL(added)]
    kept = [c for c in docs.columns if c.lower() not in (*names, text.lower())]
    texts = docs.filter(training).select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long") + 1).alias("n"), F.count("*").alias("d")).first()
    n_ranges = max(1, -(-(size["n"] or 0) // RANGE_BYTES))
    counted = stored(count_ngrams(texts, n_ranges))
    told = counted.agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
    total, distinct = told["n"] or 0, told["v"] or 0
    levels = counted.select(F.posexplode("by_level").alias("level", "n")).groupBy("level").agg(F.sum("n").alias("n")).collect()
    by_level = np.zeros(64, np.int64)
    for r in levels:
        by_level[r["level"]] = r["n"]
    context = docs.sparkSession.sparkContext
    small = lowest_level(by_level) == 1
    shared = context.broadcast((*(fill_filter(counted, n_ranges) if small else (b"", np.zeros(0, np.int64))), *frequent_words(counted)))
    per_token = float(np.log10(total + distinct + 1))
    starts = float(size["d"])

    def scored(part: pa.RecordBatch | pa.Table, levels: Callable[[np.ndarray], np.ndarray], known: np.ndarray, times: np.ndarray) -> list[pa.Array]:
        """The kept columns and the `inner` ones of some rows."""
        texts = part.column(text)
        tokens, pairs, n = token_hashes(*as_bytes(texts))
        owner = np.repeat(np.arange(len(n)), n)
        distinct, at = np.unique(tokens, return_inverse=True)
        # what the filter says
        single = count_of(levels(distinct))
        prior = (single + 1) / (total + distinct_total + 1)
        before = np.empty(len(tokens))
        before[1:] = single[at[:-1]]
        stop = np.cumsum(n)
        before[stop - n] = starts
        pair = np.minimum(count_of(levels(pairs)), before)
        share = np.where(before > 0, PAIR_SHARE, 0.0)
        log = np.log10(share * pair / np.maximum(before, 1) + (1 - share) * prior[at])
        score = np.bincount(owner, log, len(n))
        # exact counts, as far as they are here
        where = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
        frequent = known[where] == distinct if len(known) else np.zeros(len(distinct), bool)
        count = np.where(frequent, times[where], 0) if len(known) else np.zeros(len(distinct), np.int64)
        exact = np.bincount(owner, np.log10(count + 1.0)[at], len(n))
        sure = np.bincount(owner, frequent[at], len(n)).astype(np.int64)
        rare = np.flatnonzero(~frequent[at])
        stops = np.searchsorted(owner[rare], np.arange(len(n) + 1))
        offsets = pa.array(stops, pa.int32())
        return [
            *(part.column(c) for c in kept),
            pa.array(n, pa.int64()),
            pa.array(sure, pa.int64()),
            pa.array(exact),
            pa.array(score),
            pa.ListArray.from_arrays(offsets, pa.array(tokens[rare].view(np.int64))),
        ]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sizes, known, times = shared.value
        bloom = Filter(held, sizes)
        for batch in batches:
            for part in pieces(batch, text, TOGETHER):
                yield pa.RecordBatch.from_arrays(scored(part, bloom.levels, known, times), names=[*kept, *inner])

    def read_piece(rows: pa.Table, told: pa.Table) -> pa.Table:
        _, _, known, times = shared.value
        part = rows.combine_chunks().to_batches()[0]
        tokens, pairs, _ = token_hashes(*as_bytes(part.column(text)))
        hashes = np.unique(np.concatenate([tokens, pairs]))  # as they were asked for, range by range
        levels = unpacked(told.sort_by("range")["levels"], np.uint8).astype(np.int64)
        return pa.table(scored(part, lambda of: levels[np.searchsorted(hashes, of)], known, times), names=[*kept, *inner])

    distinct_total = distinct
    inner = ["__tokens", "__sure", "__exact", "__score", "__rare"]
    needed = docs.select(*dict.fromkeys([*kept, text]))
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + list(T.StructType.fromDDL("__tokens long, __sure long, __exact double, __score double, __rare array<long>"))
    )
    if small:
        told = needed.mapInArrow(read, schema)
    else:
        held = numbered_pieces(needed, text)
        answers = stored(levels_of_pieces(held, text, counted, n_ranges))  # so that the hashes asked for go first
        told = held.groupBy("__piece").cogroup(answers.groupBy("__piece")).applyInArrow(read_piece, schema)
    first = stored(told.withColumn("__row", F.monotonically_increasing_id()))
    words = counted.select("hashes", "counts").mapInArrow(_unpacked, "hash long, n long")
    rare = first.select("__row", F.explode("__rare").alias("hash")).groupBy("hash", "__row").agg(F.count("*").alias("times"))
    found = (
        rare.join(words, "hash")
        .groupBy("__row")
        .agg(F.sum("times").alias("__more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("__log"))
    )
    none = F.lit(0)
    return first.join(found, "__row", "left").select(
        *kept,
        F.col("__tokens").alias("n_tokens"),
        (F.col("__sure") + F.coalesce("__more", none)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("__exact") + F.coalesce("__log", none) - F.col("__tokens") * per_token).alias("base_score"),
        F.col("__score").alias("score"),
    )

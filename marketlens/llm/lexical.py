"""Ranked lexical search: each item's best documents by a frequency, length and rarity score in whole numbers.

The documents become a forward index that holds the items' terms only, written once. Each task reads its part of it in
shards of bounded size and turns a shard into posting lists. An item's short lists are summed up first, term at a time,
into one list of accumulators; that list and the long ones are then walked document at a time, by blocks of neighbouring
documents: a block whose largest possible score is below the k-th best so far is skipped, and long lists that cannot make
up the difference are only asked about the candidates of the others. No posting is shuffled; a task gives back k rows
for each item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import as_bytes, mixed, pieces, stored
from .words import _powers

#: Bytes of terms that the items of one round may have, so much is sent to all workers; more items take more rounds.
ROUND_BYTES = 16 << 20
#: Buckets that items are dealt into, out of which rounds are made.
ITEM_BUCKETS = 4_096
#: Bytes of a very long text that are looked at together.
SLICE_BYTES = 4 << 20
#: Documents and postings of a shard, at most (a single document is never split).
SHARD_DOCS, SHARD_POSTINGS = 32_768, 4 << 20
#: Neighbouring documents that are skipped together, and blocks that are walked before the bound is raised.
BLOCK, STRIDE = 128, 64
#: A list is short if it names at most this share of a shard's documents.
SHORT = 16

_INK = np.zeros(256, bool)
_INK[48:58] = _INK[65:91] = _INK[97:123] = _INK[128:] = True
with np.errstate(over="ignore"):
    _VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _VALUE[_LOWER]


# ------------------------------------------------------------------------ terms


def term_spans(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of texts in a row start and end. A term is a run of ASCII letters, digits and bytes above 127,
    so in UTF-8 any character above 127 belongs to one; no term reaches across texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ink = _INK[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    at = begin[:-1][begin[:-1] < len(data)]
    first[at] = ink[at]
    before = begin[1:][begin[1:] > 0] - 1
    last[before] = ink[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def term_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the terms, A to Z as small letters."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        letters = np.where(_INK[data], _VALUE[data], np.uint64(0))
        letters *= up
        edges = np.empty(2 * len(start), np.int64)  # terms that touch, at the border of two texts, are summed apart
        edges[0::2], edges[1::2] = start, end
        sums = np.add.reduceat(np.append(letters, np.uint64(0)), edges)[0::2]
        return mixed(sums * down[start])


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of runs, one after another."""
    shift = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    return data[np.arange(int(size.sum())) + shift]


@dataclass
class Vocabulary:
    """The terms of a round of items in the order of their hashes, and the terms of each item."""

    hashes: np.ndarray
    start: np.ndarray
    size: np.ndarray
    text: np.ndarray
    item_ids: list
    item_begin: np.ndarray
    item_terms: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[object, list[bytes]]]) -> Vocabulary:
        terms = sorted({t for _, own in items for t in own})
        text = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if terms else size
        hashes = term_hashes(text, start, start + size)
        order = np.argsort(hashes, kind="stable")
        place = {terms[k]: i for i, k in enumerate(order.tolist())}
        own = [sorted(place[t] for t in have) for _, have in items]
        begin = np.cumsum([0, *map(len, own)])
        return cls(hashes[order], start[order], size[order], text, [i for i, _ in items], begin, np.array([t for x in own for t in x], np.int64))

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each term, or -1. Equal hashes are not trusted: bytes are compared."""
        if not len(self.hashes) or not len(start):
            return np.full(len(start), -1)
        hashes = term_hashes(data, start, end)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = np.full(len(start), -1)
        maybe = np.flatnonzero((self.hashes[at] == hashes) & (self.size[at] == end - start))
        found, size = at[maybe], (end - start)[maybe]
        if len(maybe):
            same = _LOWER[_gathered(data, start[maybe], size)] == _gathered(self.text, self.start[found], size)
            whole = np.logical_and.reduceat(same, np.concatenate([[0], np.cumsum(size)[:-1]]))
            number[maybe[whole]] = found[whole]
        twins = np.flatnonzero(self.hashes[1:] == self.hashes[:-1])
        for k in np.unique(self.hashes[twins]).tolist():  # terms of one hash, should there be any
            for i in np.flatnonzero((hashes == np.uint64(k)) & (number < 0)).tolist():
                word = _LOWER[data[start[i] : end[i]]].tobytes()
                for j in np.flatnonzero(self.hashes == np.uint64(k)).tolist():
                    if self.text[self.start[j] : self.start[j] + self.size[j]].tobytes() == word:
                        number[i] = j
        return number


def _slices(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts that end between two terms; a term longer than a part stays whole."""
    begin = 0
    while begin < len(data):
        stop = min(begin + SLICE_BYTES, len(data))
        while stop < len(data):
            blank = np.flatnonzero(~_INK[data[stop : stop + 65_536]])
            if len(blank):
                stop += int(blank[0])
                break
            stop = min(stop + 65_536, len(data))
        yield data[begin:stop]
        begin = stop


def count_terms(data: np.ndarray, begin: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each text has, and (text, term, count) of those in the vocabulary, in this order."""
    if len(begin) == 2 and len(data) > SLICE_BYTES:
        parts = [_count_together(x, np.array([0, len(x)]), words) for x in _slices(data)]
        term, back = np.unique(np.concatenate([x[2] for x in parts]), return_inverse=True)
        count = np.zeros(len(term), np.int64)
        np.add.at(count, back, np.concatenate([x[3] for x in parts]))
        return np.array([sum(int(x[0][0]) for x in parts)]), np.zeros(len(term), np.int64), term, count
    return _count_together(data, begin, words)


def _count_together(data: np.ndarray, begin: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    size = max(1, len(words.hashes))
    start, end = term_spans(data, begin)
    cuts = np.searchsorted(start, begin)
    number = words.find(data, start, end)
    known = np.flatnonzero(number >= 0)
    doc = np.searchsorted(cuts, known, "right") - 1
    key, count = np.unique(doc * size + number[known], return_counts=True)
    return np.diff(cuts), key // size, key % size, count


# ---------------------------------------------------------------------- shards


@dataclass
class Shard:
    """Posting lists of some documents: for each term its documents, in ascending order, and what it adds to their scores."""

    ids: np.ndarray
    n_docs: int
    begin: np.ndarray
    docs: np.ndarray
    adds: np.ndarray
    #: for each term the blocks it occurs in and the most it adds there
    block_begin: np.ndarray
    blocks: np.ndarray
    tops: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n: int, total: int) -> Shard:
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id, so the walk is in the order of ids
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        doc, terms = np.repeat(rank, sizes), terms.astype(np.int64)
        if total and int(lengths.max(initial=0)) * 90 * n < 1 << 63:
            m = 10 + (90 * n * lengths.astype(np.int64)) // total
        else:
            m = np.array([10 + (90 * n * int(x)) // max(total, 1) for x in lengths], np.int64)
        adds = weights[terms] * ((1_000_000_000 * tfs) // (1_000 * tfs + 8 * np.repeat(m, sizes)))
        by_term = np.argsort(terms * len(ids) + doc)  # no two are equal
        terms, doc, adds = terms[by_term], doc[by_term], adds[by_term]
        every = np.arange(len(weights) + 1)
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (doc[1:] // BLOCK != doc[:-1] // BLOCK)
        at = np.flatnonzero(new)
        tops = np.maximum.reduceat(adds, at) if len(at) else adds
        return cls(ids[order], len(ids), np.searchsorted(terms, every), doc, adds, np.searchsorted(terms[at], every), doc[at] // BLOCK, tops)

    def best(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best documents, better ones first. Those below `floor` may be left out."""
        n_blocks = -(-self.n_docs // BLOCK)
        sums = np.zeros(self.n_docs, np.int64)
        long, long_tops = [], []
        for t in terms.tolist():
            a, b = self.begin[t], self.begin[t + 1]
            if (b - a) * SHORT <= self.n_docs:  # term at a time
                sums[self.docs[a:b]] += self.adds[a:b]
            else:
                long.append((self.docs[a:b], self.adds[a:b]))
                x, y = self.block_begin[t], self.block_begin[t + 1]
                row = np.zeros(n_blocks, np.int64)
                row[self.blocks[x:y]] = self.tops[x:y]
                long_tops.append(row)
        doc = np.flatnonzero(sums)
        held = (doc, sums[doc])
        # a score is at least what is summed up already
        if len(held[0]) >= k:
            floor = max(floor, int(np.partition(held[1], -k)[-k]))
        if not long:
            return self._top(*held, k, floor)
        # document at a time over the accumulators and the long lists, the ones that add least first
        order = sorted(range(len(long)), key=lambda i: int(long_tops[i].max()))
        walked = [*(long[i] for i in order), held]
        padded = np.zeros(n_blocks * BLOCK, np.int64)
        padded[: self.n_docs] = sums
        tops = np.stack([*(long_tops[i] for i in order), padded.reshape(-1, BLOCK).max(axis=1)])
        most = tops.sum(axis=0)
        doc, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        while at < n_blocks:
            alive = at + np.flatnonzero(most[at:] >= floor)[:STRIDE]
            if not len(alive):
                break
            at = int(alive[-1]) + 1
            new_doc, new_score = self._walk(walked, tops, alive, floor)
            doc, score = np.concatenate([doc, new_doc]), np.concatenate([score, new_score])
            keep = np.lexsort((doc, -score))[:k]
            doc, score = doc[keep], score[keep]
            if len(score) == k:
                floor = max(floor, int(score[-1]))
        return self._top(doc, score, k, floor)

    def _walk(self, walked: list, tops: np.ndarray, blocks: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of some blocks with their whole scores; those that cannot reach the floor may be left out."""
        first, stop = int(blocks[0]) * BLOCK, min((int(blocks[-1]) + 1) * BLOCK, self.n_docs)
        open_ = np.zeros(-(-(stop - first) // BLOCK), bool)
        open_[blocks - int(blocks[0])] = True
        open_ = np.repeat(open_, BLOCK)[: stop - first]
        # lists whose tops together stay below the floor need not be walked: they cannot bring up a candidate alone
        reach = np.cumsum(tops[:, blocks].max(axis=1))
        asked = int(np.searchsorted(reach, floor, "left")) if floor > 0 else 0
        asked = min(asked, len(walked) - 1)
        sums, seen = np.zeros(stop - first, np.int64), np.zeros(stop - first, bool)
        for doc, add in walked[asked:]:
            a, b = np.searchsorted(doc, (first, stop))
            sums[doc[a:b] - first] += add[a:b]
            seen[doc[a:b] - first] = True
        found = np.flatnonzero(seen & open_)
        score = sums[found]
        for i in range(asked - 1, -1, -1):  # ask the rest about candidates that can still get there
            keep = score + int(reach[i]) >= floor
            found, score = found[keep], score[keep]
            doc, add = walked[i]
            place = np.minimum(np.searchsorted(doc, found + first), len(doc) - 1)
            score = score + np.where(doc[place] == found + first, add[place], 0)
        return found + first, score

    def _top(self, doc: np.ndarray, score: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        fit = (score >= floor) & (score > 0)
        doc, score = doc[fit], score[fit]
        keep = np.lexsort((doc, -score))[:k]
        return self.ids[doc[keep]], score[keep]


# ---------------------------------------------------------------------- search


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, terms): the distinct terms of all texts of an item."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, begin = as_bytes(part.column("text"))
                start, end = term_spans(data, begin)
                row = np.searchsorted(begin, start, "right") - 1
                small = _LOWER[data]
                terms = [small[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(row)), pa.array(terms, pa.binary())], names=["item", "term"])

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).filter("item IS NOT NULL")
    return rows.mapInArrow(cut_up, f"item {kind}, term binary").distinct().groupBy("item").agg(F.collect_list("term").alias("terms"))


def _rounds(items: DataFrame) -> list[list[int]]:
    """Buckets of items, put together so that a round's terms have ROUND_BYTES at most, if no bucket has more."""
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 32)
    buckets = items.groupBy("bucket").agg(F.sum(size).alias("size")).orderBy("bucket").collect()  # ITEM_BUCKETS rows at most
    out, room = [], 0
    for row in buckets:
        if not out or row["size"] > room:
            out.append([])
            room = ROUND_BYTES
        out[-1].append(row["bucket"])
        room -= row["size"]
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k documents of the highest score above 0 for each item: (item_id, rank, doc_id, score).

    Every document counts in the statistics and is ranked, a null text as one without terms. A row whose id is null
    counts in the statistics, but is not ranked. Rows that repeat a document's id are documents of their own; rows that
    repeat an item's id are one item with the terms of all of them, and an item without id is left out. Equal scores go
    by ascending id, equal ids in no order. Ids are whole numbers of up to 64 bits. Items without terms, without a
    document that shares one, and empty tables have no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    terms = stored(_item_terms(items, item_id, item_text).withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(ITEM_BUCKETS)).cast("int")))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    found = None
    for buckets in _rounds(terms):
        rows = terms.filter(F.col("bucket").isin(buckets)).collect()  # bounded by ROUND_BYTES
        words = Vocabulary.of([(r["item"], [bytes(t) for t in r["terms"]]) for r in rows])
        some = _best_of_round(texts, spark.sparkContext.broadcast(words), len(words.hashes), k)
        # only numbers of items leave the tasks
        names = spark.createDataFrame(list(enumerate(words.item_ids)), f"nth int, {item_id} {items.schema[item_id].dataType.simpleString()}")
        best = Window.partitionBy("nth").orderBy(F.col("score").desc(), "id")
        some = some.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        some = some.join(F.broadcast(names), "nth").select(item_id, "rank", F.col("id").alias(doc_id), "score")
        found = some if found is None else found.unionByName(some)
    if found is None:
        kind = items.schema[item_id].dataType.simpleString()
        return spark.createDataFrame([], f"{item_id} {kind}, rank int, {doc_id} long, score long")
    return found


def _best_of_round(texts: DataFrame, words, n_terms: int, k: int) -> DataFrame:
    """(nth, id, score): the k best of each task for each item of the vocabulary, by its number."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words.value
        for batch in batches:
            for part in pieces(batch, "text"):
                lengths, doc, term, count = count_terms(*as_bytes(part.column("text")), own)
                begin = pa.array(np.searchsorted(doc, np.arange(len(lengths) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(lengths.astype(np.int64)),
                        pa.ListArray.from_arrays(begin, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(begin, pa.array(count.astype(np.int64))),
                    ],
                    names=["id", "length", "terms", "tfs"],
                )

    forward = stored(texts.mapInArrow(index, "id long, length long, terms array<int>, tfs array<long>"))

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["term", "df"])

    told = forward.agg(F.count(F.when(F.col("length") > 0, 1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total")).first()
    n, total = told["n"], told["total"]
    weights = np.zeros(n_terms, np.int64)  # a row for each term of the round
    for row in forward.select("terms").mapInArrow(holders, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        weights[row["term"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * row["df"] + 1)))
    known = texts.sparkSession.sparkContext.broadcast(weights)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = words.value, known.value
        n_items = len(own.item_ids)
        ids = [np.zeros(0, np.int64)] * n_items
        scores = [np.zeros(0, np.int64)] * n_items
        for shard in _shards(batches, weight, n, total):
            for i in range(n_items):
                floor = int(scores[i][-1]) if len(scores[i]) == k else 1
                new_id, new_score = shard.best(own.item_terms[own.item_begin[i] : own.item_begin[i + 1]], k, floor)
                if len(new_id):
                    both, score = np.concatenate([ids[i], new_id]), np.concatenate([scores[i], new_score])
                    keep = np.lexsort((both, -score))[:k]
                    ids[i], scores[i] = both[keep], score[keep]
        nth = np.repeat(np.arange(n_items, dtype=np.int32), [len(x) for x in ids])
        if len(nth):
            yield pa.RecordBatch.from_arrays([pa.array(nth), pa.array(np.concatenate(ids)), pa.array(np.concatenate(scores))], names=["nth", "id", "score"])

    return forward.filter("id IS NOT NULL").mapInArrow(walk, "nth int, id long, score long")


def _shards(batches: Iterator[pa.RecordBatch], weight: np.ndarray, n: int, total: int) -> Iterator[Shard]:
    held, docs, postings = [], 0, 0

    def made() -> Shard:
        column = lambda name: np.concatenate([x[name] for x in held])
        return Shard.of(column("id"), column("length"), column("size"), column("term"), column("tf"), weight, n, total)

    for batch in batches:
        for first in range(0, batch.num_rows, 4_096):
            part = batch.slice(first, 4_096)
            terms = part.column("terms")
            own = {
                "id": part.column("id").to_numpy(),
                "length": part.column("length").to_numpy(),
                "size": np.diff(terms.offsets.to_numpy()).astype(np.int64),
                "term": terms.flatten().to_numpy(),
                "tf": part.column("tfs").flatten().to_numpy(),
            }
            if held and (docs + part.num_rows > SHARD_DOCS or postings + len(own["term"]) > SHARD_POSTINGS):
                yield made()
                held, docs, postings = [], 0, 0
            held.append(own)
            docs, postings = docs + part.num_rows, postings + len(own["term"])
    if held:
        yield made()

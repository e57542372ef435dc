"""Removal of byte strings of a given length that occur more than once, by a depth-limited radix sort of all suffixes.

Suffixes are told apart only as far as LENGTH bytes, by passes over digits, the most significant first; whatever a pass
leaves alone in its group occurs once and drops out, and the groups that are left in the end are exactly the repeated
windows. The digits of a window are not its first bytes but, so that few suffixes need to be moved,

1. its anchor: the one of its substrings of DIGIT bytes that has the least hash (the leftmost of equal ones). Equal windows
   have equal anchors at equal places, and neighbouring windows mostly share one, so a pass handles runs of windows;
2. the whole run of neighbouring windows with that anchor: a run that occurs twice consists of repeated windows only;
3. for the other runs whose anchor occurs in several runs, every single window.

The first two passes only count and are reduced before they are shuffled. What came up in them goes back to the texts as
fixed-size bitmaps. A false hit in a bitmap moves a run in vain and changes no result. Strings are compared by hashes of
64 bits of the anchor together with 64 bits of the run or window.

Texts are named by hash and length: equal texts share their spans, and a group of copies is one text to all later steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bitmaps import bitmap_of, hits
from .frames import as_bytes, cut, mixed, pieces
from .words import _powers

LENGTH, DIGIT = 200, 50
#: Runs that a task sorts together, about; an anchor with more runs than MANY_RUNS is sorted window by window in the open.
GROUP_RUNS, MANY_RUNS = 2_048, 8_192
#: Text that a task looks at together; it takes about 115 times as much memory meanwhile.
PIECE_BYTES = 1 << 18

_VALUE = mixed(np.arange(1001, 1257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE_BITS = np.uint64(32)


class Hashes:
    """Hashes of any substring of some bytes, from sums over all prefixes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_VALUE[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[stop] - self.sums[start]) * self.down[start])


def runs(data: np.ndarray, begin: np.ndarray, length: int, digit: int) -> tuple[np.ndarray, ...]:
    """All windows of the texts as runs with a common anchor: first and last window, the anchor's place, its hash, and the
    hash of the run. No window reaches across texts."""
    width = length - digit + 1
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = Hashes(data)
    places = np.arange(len(data) - digit + 1)
    grams = hashes.of(places, places + digit)
    key = (grams >> _PLACE_BITS << _PLACE_BITS) | places.astype(np.uint64)
    # least key of every `width` neighbours, from running minima of blocks to the left and to the right
    rows = -(-len(key) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    padded = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    stop = np.repeat(begin[1:], np.diff(begin))[:n]  # of the text that a window begins in
    valid = np.flatnonzero(np.arange(n) + length <= stop)
    if not len(valid):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    at = anchor[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
    edge = np.flatnonzero(new)
    first, last, at = valid[edge], valid[np.append(edge[1:], len(valid)) - 1], at[edge]
    with np.errstate(over="ignore"):
        shape = mixed((at - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64))
        whole = mixed(hashes.of(first, last + length) + shape)
    return first, last, at, grams[at], whole


def runs_of(batches: Iterator[pa.RecordBatch], length: int, digit: int) -> Iterator[tuple]:
    """Of each piece of the batches: its rows, each run's text (row of the piece), first and last window and anchor within it
    and its hashes, the texts' bytes, and where in them each run's text begins."""
    for batch in batches:
        for part in pieces(batch, "text", PIECE_BYTES):
            data, begin = as_bytes(part.column("text"))
            first, last, at, gram, whole = runs(data, begin, length, digit)
            owner = np.searchsorted(begin, first, "right") - 1
            base = begin[owner]
            yield part, owner, first - base, last - base, at - base, gram, whole, data, base


def without_copies(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of a batch with the first of each key."""
    first = np.unique(batch.column("key").to_numpy(), return_index=True)[1]
    return batch if len(first) == batch.num_rows else batch.take(pa.array(np.sort(first)))


def place_hash(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A run's name: its text and where it begins in it."""
    with np.errstate(over="ignore"):
        return mixed(key.view(np.uint64) + mixed(start.astype(np.uint64)))


def both(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(first ^ mixed(second))


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of what some spans cover."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def repeated_spans(texts: DataFrame, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """(key, size, start, stop): byte spans of the texts (key, size, text) that windows cover which also begin elsewhere.

    A text that stands there more than once is repeated throughout. Spans may overlap; they are whole in their union.
    """
    session = texts.sparkSession.sparkContext

    # pass 1; of most anchors there is one, and nothing of them goes on
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, _, _, gram, whole, _, _ in runs_of(batches, length, digit):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (gram, whole)], names=["gram", "run"])

    first = texts.mapInArrow(anchors, "gram long, run long").groupBy("gram")
    first = first.agg(F.count("*").alias("n"), F.min("run").alias("run"), F.max("run").alias("other")).filter("n > 1")
    first = cut(first)
    mixed_anchors = session.broadcast(bitmap_of(first.filter("run != other").select("gram")))

    # pass 2: of the anchors with several runs; the run of the least name stands for all equal ones
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(mixed_anchors.value, np.uint8)
        for part, owner, start, _, _, gram, whole, _, _ in runs_of(batches, length, digit):
            on = hits(bits, gram)
            name = place_hash(part.column("key").to_numpy()[owner[on]], start[on])
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (gram[on], whole[on], name)], names=["gram", "run", "name"])

    second = texts.mapInArrow(named, "gram long, run long, name long")
    second = cut(second.groupBy("gram", "run").agg(F.count("*").alias("n"), F.min("name").alias("name")))
    again = first.filter("run = other").select("gram", "run").union(second.filter("n > 1").select("gram", "run")).distinct()

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = both(batch.column("gram").to_numpy().view(np.uint64), batch.column("run").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64))], names=["pair"])

    per_anchor = second.groupBy("gram").agg(F.count("*").alias("n_runs"))
    shared = session.broadcast(
        (
            bitmap_of(again.mapInArrow(pair, "pair long")),
            bitmap_of(second.select("name")),
            bitmap_of(per_anchor.filter(F.col("n_runs") > MANY_RUNS).select("gram")),
        )
    )
    n_groups = max(1, -(-second.count() // GROUP_RUNS))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs that occur again, without bytes, and runs whose windows are to be compared, with theirs; of copies of a
        text that lie together each run once. Those to be compared have a group; in group -1 they are laid open."""
        repeated, open_runs, crowded = (np.frombuffer(x, np.uint8) for x in shared.value)
        for part, owner, start, last, at, gram, whole, data, base in runs_of(map(without_copies, batches), length, digit):
            key, size = part.column("key").to_numpy()[owner], part.column("size").to_numpy()[owner]
            name = place_hash(key, start)
            once = np.zeros(len(name), bool)
            once[np.unique(name, return_index=True)[1]] = True
            group = (mixed(gram) % np.uint64(n_groups)).astype(np.int64)
            group[hits(crowded, gram)] = -1
            full = np.flatnonzero(once & hits(repeated, both(gram, whole)))
            compare = np.flatnonzero(once & hits(open_runs, name))
            body = [data[a : b + length].tobytes() for a, b in zip((base + start)[compare].tolist(), (base + last)[compare].tolist(), strict=True)]
            for chosen, texts_of in ((full, [None] * len(full)), (compare, body)):
                columns = [group, key, size, start, last, at, gram.view(np.int64), whole.view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[chosen], pa.int64()) for c in columns] + [pa.array(texts_of, pa.binary())], names=names
                )

    names = ["group", "key", "size", "first", "last", "at", "gram", "run", "bytes"]
    picked = texts.mapInArrow(pick, ", ".join(f"{c} long" for c in names[:-1]) + ", bytes binary")
    full = picked.filter("bytes IS NULL").select("key", "size", "first", "last", "gram", "run").join(again, ["gram", "run"], "left_semi")
    spans = full.select("key", "size", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
    open_runs = picked.filter("bytes IS NOT NULL")

    # pass 3
    def windows(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every window of some runs: its row, its place in the row's text, and its hash with its anchor's."""
        data, begin = as_bytes(rows["bytes"].combine_chunks() if isinstance(rows, pa.Table) else rows["bytes"])
        first, last, at, gram = (rows[c].to_numpy() for c in ("first", "last", "at", "gram"))
        many = last - first + 1
        row = np.repeat(np.arange(len(first)), many)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        start = begin[:-1][row] + offset
        content = Hashes(data).of(start, start + length)
        place = first[row] + offset
        with np.errstate(over="ignore"):
            name = both(gram[row].view(np.uint64), content + mixed((at[row] - place).astype(np.uint64)))
        return row, place, name

    def spans_of(rows: pa.Table | pa.RecordBatch, row: np.ndarray, place: np.ndarray) -> pa.Table:
        """Windows in ascending order, neighbours put together."""
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
        edge = np.flatnonzero(new)
        last = np.append(edge[1:], len(row))[: len(edge)] - 1
        key, size = rows["key"].to_numpy()[row[edge]], rows["size"].to_numpy()[row[edge]]
        return pa.table([key, size, place[edge], place[last] + length], names=["key", "size", "start", "stop"])

    def sort_group(rows: pa.Table) -> pa.Table:
        name = place_hash(rows["key"].to_numpy(), rows["first"].to_numpy())
        rows = rows.take(np.sort(np.unique(name, return_index=True)[1]))  # copies of a text that lay apart
        row, place, name = windows(rows)
        _, inverse, times = np.unique(name, return_inverse=True, return_counts=True)
        twice = times[inverse] > 1
        return spans_of(rows, row[twice], place[twice])

    few = open_runs.filter("group >= 0").groupBy("group")
    spans = spans.union(few.applyInArrow(sort_group, "key long, size long, start long, stop long"))

    def lay_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "bytes", PIECE_BYTES):
                row, place, name = windows(part)
                key, size = part.column("key").to_numpy()[row], part.column("size").to_numpy()[row]
                gram = part.column("gram").to_numpy()[row]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, name.view(np.int64), key, size, place)], names=["gram", "window", "key", "size", "place"])

    if not per_anchor.filter(F.col("n_runs") > MANY_RUNS).isEmpty():
        # a window's row is its text and place: of copies one is left before any are counted
        opened = open_runs.filter("group < 0").mapInArrow(lay_open, "gram long, window long, key long, size long, place long")
        opened = cut(opened.distinct())
        twice = opened.groupBy("gram", "window").agg(F.count("*").alias("n")).filter("n > 1").select("gram", "window")
        spans = spans.union(
            opened.join(twice, ["gram", "window"], "left_semi").select("key", "size", F.col("place").alias("start"), (F.col("place") + length).alias("stop"))
        )
    return spans


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, digit: int = DIGIT, digest: bool = True) -> DataFrame:
    """Each row with n_bytes, n_removed and n_spans, and with kept_sha256 in place of its text or with what is left of it.

    Every byte is removed that a string of `length` bytes covers which begins somewhere else as well, in the same text or
    another; overlapping strings count, and all occurrences go, the first one too. Null and shorter texts lose nothing;
    null counts as empty. Equal texts of that length, repeated rows among them, go whole. Without `digest` the text column
    holds what is left, null staying null; characters of which only some bytes are covered are kept there, so that the
    text remains UTF-8. Columns that are named like the added ones give way to them. An empty table gives no rows.
    """
    if not 0 < digit <= length:
        raise ValueError("digit must lie between 1 and length")
    names = ["n_bytes", "n_removed", "n_spans", *(["kept_sha256"] if digest else [])]
    kept = [c for c in docs.columns if c.lower() not in names]
    named = docs.select(
        *[c for c in kept if not digest or c != text], F.coalesce(F.col(text), F.lit("")).alias("__text") if digest else F.col(text).alias("__text")
    ).withColumns({"__key": F.xxhash64("__text"), "__size": F.octet_length(F.coalesce("__text", F.lit(""))).cast("long")})
    others = [c for c in kept if c != text]
    texts = named.filter(F.col("__size") >= length).select(F.col("__key").alias("key"), F.col("__size").alias("size"), F.col("__text").alias("text"))
    spans = (
        repeated_spans(texts, length, digit)
        .groupBy(F.col("key").alias("__key"), F.col("size").alias("__size"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("__spans"))  # of one text: as many as it has bytes at most
    )
    schema = T.StructType(
        [docs.schema[c] for c in others]
        + list(T.StructType.fromDDL("n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digest else "__left string")))
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "__text"):
                data, begin = as_bytes(part.column("__text"))
                size, removed, n_spans, left = [], [], [], []
                for a, b, raw in zip(begin[:-1].tolist(), begin[1:].tolist(), part.column("__spans"), strict=True):
                    own = data[a:b]
                    found = np.array([(x["start"], x["stop"]) for x in raw.as_py() or ()], np.int64).reshape(-1, 2)
                    start, stop = merged(found[:, 0], found[:, 1])
                    size.append(len(own))
                    n_spans.append(len(start))
                    if not digest:  # back to whole characters: their later bytes are 10xxxxxx
                        inner = np.append((own & 0xC0) == 0x80, False)
                        edges = np.flatnonzero(~inner)
                        start = edges[np.searchsorted(edges, start)]
                        stop = edges[np.searchsorted(edges, stop, "right") - 1]
                    change = np.zeros(len(own) + 1, np.int32)
                    np.add.at(change, start, 1)
                    np.add.at(change, stop, -1)
                    stays = own[np.cumsum(change)[:-1] <= 0].tobytes()
                    removed.append(len(own) - len(stays))
                    left.append(hashlib.sha256(stays).hexdigest() if digest else stays)
                last = pa.array(left, pa.string() if digest else pa.binary())
                if not digest:
                    last = last.cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in others] + [pa.array(x, pa.int64()) for x in (size, removed, n_spans)] + [last],
                    names=[*others, "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "__left"],
                )

    joined = named.join(spans, ["__key", "__size"], "left").select(*others, "__text", "__spans")
    if digest:
        return joined.mapInArrow(remove, schema)
    blank = joined.withColumn("__null", F.col("__text").isNull())
    schema = T.StructType([*schema.fields[: len(others)], T.StructField("__null", T.BooleanType()), *schema.fields[len(others) :]])
    others = [*others, "__null"]
    out = blank.mapInArrow(remove, schema)
    return out.select(*[F.when(~F.col("__null"), F.col("__left")).alias(text) if c == text else F.col(c) for c in kept], "n_bytes", "n_removed", "n_spans")

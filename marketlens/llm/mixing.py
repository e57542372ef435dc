"""Mixing sources to target weights by Pfair scheduling.

Time is a row of slots, and each slot takes one block of documents of one source. With weight w the k-th block of a source
(from 0) is released at floor(k / w) and due by ceil((k + 1) / w); the released block that is due first gets the slot.
The period is the mixture itself: a source has a whole number of blocks in it, its target up to less than one block, and
weights are these numbers over their sum. They add up to 1, so every block meets its window: at every point of the mixture
each source is less than one block away from its share.

Where the numbers have a common divisor windows repeat, and only one round of them is scheduled. The schedule is eight bytes
a block, on the driver and in a broadcast; documents are numbered and placed in parallel.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import cut

#: Documents of a block.
BLOCK = 8
#: Exponent that turns the sizes of sources into weights if none are given: 1 keeps their shares, 0 makes them equal.
TEMPERATURE = 0.7
#: How often a document comes up at most, if the caller says nothing else: as often as the weights need.
MOST_EPOCHS = math.inf
#: Documents that are numbered together in a task, about.
BUCKET_ROWS = 8_192
#: Copies of a repeated row that are spelled out at once.
COPIES = 1_024


def shares(weights: np.ndarray, period: int, least: np.ndarray | int = 1) -> np.ndarray:
    """Slots of each source in a period: the weights rounded by largest remainders, and so many at least."""
    exact = weights / weights.sum() * period
    slots = np.maximum(np.floor(exact).astype(np.int64), least)
    rest = period - int(slots.sum())
    if rest > 0:
        slots[np.argsort(-(exact - slots), kind="stable")[:rest]] += 1
    else:
        slots[np.argmax(slots)] += rest
    if slots.min() < 1 or slots.sum() != period:
        raise ValueError(f"{period} slots are too few for {len(weights)} sources")
    return slots


def least_period(weights: np.ndarray, blocks: np.ndarray) -> int:
    """The fewest slots that hold so many blocks of each source and leave each less than one block off its weight."""
    share = weights / weights.sum()
    low, high = int(blocks.sum()) - 1, max(int(blocks.sum()), int(np.ceil((blocks / share).max())) + 1)
    while high - low > 1:
        middle = (low + high) // 2
        exact = share * middle
        if (np.ceil(exact) >= blocks).all() and np.maximum(np.floor(exact), blocks).sum() <= middle:
            high = middle
        else:
            low = middle
    return high


def schedule(slots: np.ndarray) -> list[np.ndarray]:
    """For each source the slots of its blocks in one period: of the released blocks the one that is due first."""
    size = slots.tolist()
    period = sum(size)
    first = (np.cumsum(slots) - slots).tolist()
    waiting = [(0, i, 0) for i in range(len(size))]
    ready: list[tuple[int, int, int]] = []
    out = np.zeros(period, np.int64)
    for now in range(period):
        while waiting and waiting[0][0] <= now:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // size[i]), i, k))
        _, i, k = heapq.heappop(ready)
        out[first[i] + k] = now
        if k + 1 < size[i]:
            heapq.heappush(waiting, ((k + 1) * period // size[i], i, k + 1))
    return np.split(out, first[1:])


@dataclass
class Plan:
    """What the mixture does with each source: its slots in a round, when its blocks come, its documents and places."""

    sources: list[str]
    slots: np.ndarray
    times: list[np.ndarray]
    documents: np.ndarray
    places: np.ndarray


def plan(sources: list[str], documents: np.ndarray, weights: np.ndarray, block: int, most_epochs: float, length: int | None = None) -> Plan:
    """As many slots as it takes for every document to come up once, or as many as hold `length` documents."""
    if length is not None:
        blocks = shares(weights, -(-length // block))
        slots = blocks // np.gcd.reduce(blocks)
        return Plan(sources, slots, schedule(slots), documents, blocks * block)
    share = weights / weights.sum()
    epochs = np.minimum(share * (documents / share).max() / documents, most_epochs)
    target = epochs * documents
    blocks = -(-documents // block)
    blocks_given = shares(target, least_period(target, blocks), blocks)
    slots = blocks_given // np.gcd.reduce(blocks_given)
    return Plan(sources, slots, schedule(slots), documents, blocks_given * block)


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK, doc_id: str = "doc_id", source: str = "source", text: str | None = "text", most_epochs: float = MOST_EPOCHS, length: int | None = None) -> DataFrame:
    """(position, slot, epoch, source, doc_id, key) of every place in the mixture; positions run from 0 without a gap.

    Each source's documents come in the order of a hash, so a source that is done early begins anew: places beyond its
    documents have epoch 1 and up, as many as its weight needs. With `most_epochs` no document comes more often than that,
    give or take a block, and a source that would need more gets less than its weight. With `length` the mixture ends after
    so many documents, in whole blocks: each source has its weight's share of them, a block at least, and one that is
    larger than its share gives the first of its documents by hash. A length below a block for each source is an error.
    Sources that `weights` leaves out or gives nothing are left out; weights of absent sources count for nothing; without
    `weights` they follow from TEMPERATURE. A null source is a source of its own, a null id an id. Rows alike in source,
    id and text stand for one document that comes as often as the row is there. An empty table gives an empty mixture.

    The key is a hash of the text (of nothing, if `text` is None) that tells documents of one id apart.
    """
    if not most_epochs >= 1:
        raise ValueError(f"most_epochs is {most_epochs}; every document comes up once at least")
    if length is not None and most_epochs != MOST_EPOCHS:
        raise ValueError("a mixture of a given length has no limit of epochs")
    spark = docs.sparkSession
    name = F.concat(F.lit("="), F.col(source).cast("string"))
    rows = docs.select(
        F.coalesce(name, F.lit("")).alias("src"), F.col(doc_id).alias("doc_id"), (F.xxhash64(F.col(text)) if text else F.lit(0).cast("long")).alias("key")
    )
    # copies of a row are reduced to a count before they are shuffled
    rows = cut(rows.groupBy("src", "doc_id", "key").agg(F.count("*").alias("copies")))
    sizes = {r["src"]: r["n"] for r in rows.groupBy("src").agg(F.sum("copies").alias("n")).collect()}
    if weights is None:
        wanted = {s: float(n) ** TEMPERATURE for s, n in sizes.items()}
    else:
        given = {"" if s is None else f"={s}": float(w) for s, w in weights.items()}
        wanted = {s: given[s] for s in sizes if given.get(s, 0) > 0}
    sources = sorted(wanted)
    columns = "position long, slot long, epoch long, source string, doc_id " + docs.schema[doc_id].dataType.simpleString() + ", key long"
    if not sources:
        return spark.createDataFrame([], columns)
    p = plan(sources, np.array([sizes[s] for s in sources]), np.array([wanted[s] for s in sources]), block, most_epochs, length)
    first = np.cumsum(p.slots) - p.slots
    per_source = spark.createDataFrame(
        [(s, int(k), int(f), int(n), int(m)) for s, k, f, n, m in zip(sources, p.slots, first, p.documents, p.places, strict=True)],
        "src string, slots long, first long, documents long, places long",
    )
    times = spark.sparkContext.broadcast(np.concatenate(p.times))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            time = pa.array(times.value[batch.column("nth_of_all").to_numpy()])
            yield pa.RecordBatch.from_arrays([*batch.columns, time], names=[*batch.schema.names, "time"])

    # numbers within each source: those of the buckets before, then those in the bucket
    n_buckets = max(1, -(-sum(sizes.values()) // BUCKET_ROWS))
    rows = rows.withColumn("hash", F.xxhash64("doc_id", "key")).withColumn("bucket", F.pmod("hash", F.lit(n_buckets)))
    counts = rows.groupBy("src", "bucket").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    counts = counts.select("src", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("src", "bucket").orderBy("hash", "doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.withColumn("in_bucket", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(counts, ["src", "bucket"])
    numbered = (
        first.select("src", "doc_id", "key", "copies", (F.col("before") + F.col("in_bucket")).alias("number"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("some"))
        .select("*", F.explode(F.sequence("some", F.least(F.col("some") + COPIES, F.col("copies")) - 1)).alias("copy"))
        .select("src", "doc_id", "key", (F.col("number") + F.col("copy")).alias("number"))
    )
    period = int(p.slots.sum())
    last = F.floor((F.col("places") - 1 - F.col("number")) / F.col("documents"))
    places = (
        numbered.join(F.broadcast(per_source), "src")  # a row per source
        .filter("number < places")
        .select("*", last.alias("last"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), "last", F.lit(COPIES).cast("long"))).alias("some"))
        .select("*", F.explode(F.sequence("some", F.least(F.col("some") + COPIES - 1, "last"))).alias("epoch"))
        .withColumn("place", F.col("epoch") * F.col("documents") + F.col("number"))
        .withColumn("nth", F.floor(F.col("place") / block))
        .withColumn("nth_of_all", F.col("first") + F.col("nth") % F.col("slots"))
        .select("src", "doc_id", "key", "epoch", "place", "nth_of_all", F.floor(F.col("nth") / F.col("slots")).alias("round"))
    )
    timed = places.mapInArrow(look_up, T.StructType([*places.schema, T.StructField("time", T.LongType())]))
    places = timed.withColumn("slot", F.col("round") * period + F.col("time"))
    return places.select(
        (F.col("slot") * block + F.col("place") % block).alias("position"),
        "slot",
        "epoch",
        F.when(F.col("src") != "", F.substring("src", 2, 1 << 30)).alias("source"),
        "doc_id",
        "key",
    )


def mixed_documents(docs: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK, doc_id: str = "doc_id", source: str = "source", text: str = "text", most_epochs: float = MOST_EPOCHS, length: int | None = None) -> DataFrame:
    """The documents themselves in the order of the mixture, each as often as it comes up, with the columns of `docs`.

    Of rows alike in source, id and text one stands for all. Written files hold ascending stretches of the mixture.
    """
    places = mix(docs, weights, block, doc_id, source, text, most_epochs, length).select(F.col("position").alias("__position"), F.col("source").alias("__source"), F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    one = docs.withColumns({"__k": F.xxhash64(F.col(text))}).dropDuplicates([source, doc_id, "__k"])
    same = one[source].cast("string").eqNullSafe(places["__source"]) & one[doc_id].eqNullSafe(places["__id"]) & (one["__k"] == places["__key"])
    joined = one.join(places, same).select(*docs.columns, "__position")
    return joined.repartitionByRange("__position").sortWithinPartitions("__position").select(docs.columns)

"""Shards of near equal size that are boxes in the space of the documents' metadata: a k-d tree.

The root holds all documents and is to become all shards. A node that is to become several is split along its widest
dimension, in shares of the root's width, at a weighted median: so that the bytes left of the cut are to those right of
it as the shards on either side. That goes on until each leaf is one shard and has the target bytes. Medians are found by
counting: each round adds up the bytes of BINS intervals of every open node, in the tasks that hold the rows, and goes on
in the interval that holds the cut. All nodes of a level take part in the same rounds. Rows that are alike in a dimension
are told apart by hashes and by a number of their own, so a third of all rows in one source or one text splits like any
others, and a cut is off by one document at most. Nothing but sums of intervals comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import stored

#: Intervals that a node's keys are counted in per round.
BINS = 1_024
#: Rows that are numbered together.
SLOT_ROWS = 1 << 18

#: Name of the folders of shards.
SHARD = "shard_number"

#: What tells rows of one value in a dimension apart, in this order.
_TIES = ("h", "i", "row")


@dataclass
class Node:
    """A box that is to become `shards` shards, the first of which has the number `first`."""

    name: int
    first: int
    shards: int
    #: the dimension and the key (value, hash of the text, hash of the id, row) up to which rows go left
    dim: int | None = None
    cut: list[int] = field(default_factory=list)
    left: Node | None = None
    right: Node | None = None


def byte_size(text: Column) -> Column:
    """Bytes of a text in UTF-8, none for null, and 16 for the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def ordinal(value: Column) -> Column:
    """A string as a number that keeps the order of the first seven bytes; null comes first."""
    head = F.rpad(F.hex(F.encode(value, "UTF-8").substr(1, 7)), 14, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1).cast("long"))


def dimensions(docs: DataFrame) -> dict[str, Column]:
    """The metadata that documents are placed by: source, language, number of characters, by the columns there are."""
    out = {}
    for name in ("source", "lang"):
        if name in docs.columns:
            out[name] = ordinal(F.col(name).cast("string"))
    if "n_chars" in docs.columns:
        out["n_chars"] = F.coalesce(F.col("n_chars").cast("long"), F.lit(-1).cast("long"))
    return out


def _leaves(node: Node) -> list[Node]:
    return [node] if node.left is None else _leaves(node.left) + _leaves(node.right)


#: Beyond every key that follows, and before every other.
_LAST, _LEAST = (1 << 63) - 1, -(1 << 63)


@dataclass
class _Search:
    """What is known of a node's cut: its first parts, and the range in which the next one lies."""

    node: Node
    low: int
    high: int
    #: weight that is still to go left, out of the rows that are looked at
    share: float
    prefix: list[int] = field(default_factory=list)


def _small(spark, rows: list[tuple], columns: str) -> DataFrame:
    """A few rows as a relation of the plan, without a job that reads them."""
    names, kinds = zip(*[c.split() for c in columns.split(", ")], strict=True)
    types = [pa.int32() if k == "int" else pa.int64() if k == "long" else pa.string() for k in kinds]
    values = zip(*rows, strict=True) if rows else [[]] * len(names)
    return spark.createDataFrame(pa.table([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=list(names)))


def _find_cuts(placed: DataFrame, searches: dict[int, _Search], dims: int) -> None:
    """The cut of every node that is searched: the last key for which the weight up to it comes nearest to its share.

    A round looks at the rows that agree with the parts of the cut that are known and whose next part is in range.
    """
    spark = placed.sparkSession
    key = lambda at: F.element_at("key", F.col(at) if isinstance(at, str) else at)
    agrees = F.lit(True)
    for i, at in enumerate(["dim", dims + 1, dims + 2]):
        agrees = agrees & (F.col(f"p{i}").isNull() | (key(at) == F.col(f"p{i}")))
    while searches:
        asked = []
        for k, s in searches.items():
            p, dim = len(s.prefix), s.node.dim + 1
            # whole numbers: a narrow range has fewer intervals
            step = -(-(s.high - s.low + 1) // BINS)
            asked.append((k, dim, dims + p if p else dim, dims + min(p + 1, len(_TIES)), s.low, s.high, step, *s.prefix, *[None] * (len(_TIES) - p)))
        table = _small(spark, asked, "node int, dim int, at int, then int, low long, high long, step long, p0 long, p1 long, p2 long")
        looked = (
            placed.join(F.broadcast(table), "node")  # a row for each node that is split
            .withColumns({"value": key("at"), "next": key("then")})
            .filter(F.col("value").between(F.col("low"), F.col("high")) & agrees)
        )
        sums = looked.groupBy("node", F.expr("(value - low) div step").alias("bin")).agg(
            F.sum("size").alias("w"), F.count("*").alias("n"), F.min("value").alias("a"), F.max("value").alias("b"), F.min("next").alias("c"), F.max("next").alias("d")
        )
        bins: dict[int, list] = {}
        for r in sums.collect():  # BINS rows a node at most
            bins.setdefault(r["node"], []).append(r)
        for k, s in list(searches.items()):
            for last in sorted(bins[k], key=lambda r: r["bin"]):
                if last["w"] >= s.share:
                    break
                s.share -= last["w"]
            if last["a"] < last["b"]:
                s.low, s.high = last["a"], last["b"]
            elif last["n"] > 1 and len(s.prefix) < len(_TIES):
                s.prefix.append(last["a"])
                s.low, s.high = last["c"], last["d"]
            else:  # one row: it goes left if the cut is nearer behind it than before it
                behind = last["w"] - s.share <= s.share
                cut = [*s.prefix, last["a"] if behind else max(last["a"] - 1, _LEAST)]
                s.node.cut = cut + [_LAST] * (1 + len(_TIES) - len(cut))
                del searches[k]


def grow(rows: DataFrame, dims: int, shards: int) -> tuple[Node, DataFrame]:
    """The tree over rows that have a `key` (values in `dims` dimensions, then what tells ties apart) and a `size`; and
    the rows with their `shard`. Each level of the tree is written."""
    spark, root = rows.sparkSession, Node(0, 0, shards)
    names, width = 1, None
    placed = rows.withColumn("node", F.lit(0))
    while open_ := [n for n in _leaves(root) if n.shards > 1]:
        ends = [F.struct(F.min(F.get("key", F.lit(i))).alias("a"), F.max(F.get("key", F.lit(i))).alias("b")).alias(f"k{i}") for i in range(dims)]
        found = {r["node"]: r for r in placed.groupBy("node").agg(*ends, F.sum("size").alias("w")).collect()}  # as many as leaves
        if width is None:
            width = [max(1, found[0][f"k{i}"]["b"] - found[0][f"k{i}"]["a"]) if found else 1 for i in range(dims)]
        searches = {}
        for n in open_:
            if n.name in found:
                box = found[n.name]
                n.dim = max(range(dims), key=lambda i: ((box[f"k{i}"]["b"] - box[f"k{i}"]["a"]) / width[i], -i))  # noqa: B023
                searches[n.name] = _Search(n, *box[f"k{n.dim}"], box["w"] * (n.shards // 2) / n.shards)
            else:  # fewer rows than shards
                n.dim, n.cut = 0, [_LAST] * (1 + len(_TIES))
        _find_cuts(placed, searches, dims)
        splits = []
        for n in open_:
            half = n.shards // 2
            n.left, n.right = Node(names, n.first, half), Node(names + 1, n.first + half, n.shards - half)
            splits.append((n.name, n.dim + 1, *n.cut, names, names + 1))
            names += 2
        table = _small(spark, splits, "node int, dim int, c0 long, c1 long, c2 long, c3 long, l int, r int")
        own = F.struct(F.element_at("key", F.col("dim")), *[F.element_at("key", dims + 1 + i) for i in range(len(_TIES))])
        side = F.when(own <= F.struct("c0", "c1", "c2", "c3"), F.col("l")).otherwise(F.col("r"))
        placed = stored(
            placed.join(F.broadcast(table), "node", "left").withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(side)).select(*placed.columns)
        )
    leaves = _small(spark, [(n.name, n.first) for n in _leaves(root)], "node int, shard int")
    return root, placed.join(F.broadcast(leaves), "node").drop("node")


def boxes(spark, root: Node, dims: Sequence[str]) -> DataFrame:
    """The tree as rows: for each split the first shard and the number of shards, the dimension, the value that is cut at."""
    out = []

    def walk(n: Node) -> None:
        if n.left is not None:
            out.append((n.first, n.shards, dims[n.dim], n.cut[0]))
            walk(n.left)
            walk(n.right)

    walk(root)
    return _small(spark, out, "first_shard int, shards int, dimension string, last_value_left long")


def _keyed(docs: DataFrame, dims: dict[str, Column], doc_id: str, text: str, *rest: Column) -> tuple[DataFrame, int]:
    """Rows with their keys, written, so that the number of a row stays the same from here on; and how many dimensions."""
    body = F.coalesce(F.col(text), F.lit(""))
    values = list(dims.values()) or [byte_size(F.col(text))]
    positive = lambda h: F.shiftrightunsigned(h, 1)  # noqa: E731  so that differences fit into a long
    ties = [positive(F.xxhash64(body)), positive(F.xxhash64(F.col(doc_id).cast("string"))), F.monotonically_increasing_id()]
    key = F.array(*[v.cast("long") for v in values], *ties).alias("key")
    return stored(docs.select(F.col(doc_id).alias("id"), byte_size(F.col(text)).alias("size"), F.crc32(body).alias("crc"), key, *rest)), len(values)


def assign(
    docs: DataFrame, shards: int = 40, dims: dict[str, Column] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Per document doc_id, size, text_crc32, shard and slot; and the tree's splits (see `boxes`).

    Sizes of the shards are near equal: a cut of the tree is off by one document at most. Slots of a shard have no gaps and
    start at 0. A null text has no bytes and a checksum of 0; null metadata come before all other. Rows without id and
    rows that repeat an id, or all of a row, are rows of their own. Equal texts are neighbours where their metadata are
    equal, so a cut parts few of them; a group larger than a shard has to be parted. An empty table gives no rows, and
    with fewer rows than shards some shards are empty. Only metadata, sizes and hashes are written and read again, not
    texts. Columns that clash with names used here do no harm: none but those asked for is looked at.
    """
    dims = dimensions(docs) if dims is None else dims
    root, placed = grow(*_keyed(docs, dims, doc_id, text), shards)
    told = number(placed, ["shard"], ["key"]).select(
        F.col("id").alias(doc_id), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    )
    return told, boxes(docs.sparkSession, root, list(dims) or ["size"])


def write_shards(
    docs: DataFrame, path: str, shards: int = 40, dims: dict[str, Column] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write whole documents as Parquet below `path`, a folder `shard_number=<n>` for each shard; the tree's splits, by which a
    reader finds the shards that may hold a source, a language or a length. Rows are as in `assign`."""
    dims = dimensions(docs) if dims is None else dims
    rows, n = _keyed(docs, dims, doc_id, text, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    root, placed = grow(rows.drop("whole"), n, shards)
    placed = placed.select("key", "shard").join(rows.select("key", "whole"), "key")  # a key is a row's own
    # large shards are written by several tasks
    laid_out = placed.hint("rebalance", "shard").select(F.col("whole.*"), F.col("shard").alias(SHARD))
    laid_out.write.partitionBy(SHARD).parquet(path)
    return boxes(docs.sparkSession, root, list(dims) or ["size"])


def number(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """`slot`: a gapless number from 0 within each value of `by`. Rows of a value are dealt into buckets by a hash of the
    columns of `order`, which are unique together; a task numbers a bucket, and buckets come one after another."""
    many = max(1, -(-rows.count() // SLOT_ROWS))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(many)))
    earlier = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*by, "bucket").agg(F.count("*").alias("n")).select(*by, "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy(*by, "bucket").orderBy(*order))
    return dealt.withColumn("nth", within).join(starts, [*by, "bucket"]).withColumn("slot", F.col("start") + F.col("nth") - 1).drop("bucket", "start", "nth")

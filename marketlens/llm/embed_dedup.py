"""Near-duplicate embeddings by a pigeonhole join over subspaces.

Unit vectors are rotated at random and split into blocks of BLOCK coordinates. If two vectors are no farther apart than
the threshold allows, some block holds no more than its share of the squared distance, a share in proportion to its
coordinates. So each block is joined by range under that budget: along its first coordinate vectors fall into strips as
wide as the budget's root, and only vectors of the same or of neighbouring strips are compared. Whatever some block finds
is verified on all coordinates; a pair that several blocks find counts in the first of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .frames import cut
from .nearest import as_matrix, rotation, usable

#: Coordinates of a block.
BLOCK = 8
#: Vectors of a part of a strip; parts meet in pairs, each pair in a task of its own.
PART = 2_048
#: Rows of a distance matrix that are looked at together.
TOGETHER = 256
#: What rounding may take off a budget.
SLACK = 1e-9


def blocks(dim: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dim), max(1, dim // BLOCK))


def budgets(dim: int, threshold: float) -> np.ndarray:
    """Squared distance that each block may hold."""
    whole = 2 - 2 * threshold
    return np.array([whole * len(b) / dim for b in blocks(dim)]) + SLACK


def linked_pairs(a: np.ndarray, b: np.ndarray, allowed: np.ndarray, block: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `a` and `b` that the given block finds first and that are similar enough."""
    parts, most = blocks(a.shape[1]), budgets(a.shape[1], threshold)
    at = parts[block]
    x, y = a[:, at], b[:, at]
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    found = []
    for s in range(0, len(a), TOGETHER):
        near = xx[s : s + TOGETHER, None] + yy[None] - 2 * (x[s : s + TOGETHER] @ y.T) <= most[block] + 1e-6
        i, j = np.nonzero(near & allowed[s : s + TOGETHER])
        found.append((i + s, j))
    i = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    j = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    keep = []
    for s in range(0, len(i), 65_536):
        p, q = a[i[s : s + 65_536]], b[j[s : s + 65_536]]
        gap = (p - q) ** 2
        within = np.stack([gap[:, k].sum(axis=1) <= m for k, m in zip(parts[: block + 1], most, strict=False)], axis=1)
        keep.append(within[:, block] & ~within[:, :block].any(axis=1) & ((p * q).sum(axis=1) >= threshold))
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[keep], j[keep]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by links."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while (new != (jump := new[new])).any():
            new = jump
        new = new[label]
        if (new == label).all():
            break
        label = new
    return label


def link_vectors(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: rows link if their labels are equal and their cosine, in double
    precision, reaches the threshold.

    Rows whose label or id is null, or whose vector is null, empty, zero or has a null or non-finite component, link with
    nothing; neither do vectors of different lengths. Such a row has no links and is its own component. Equal vectors of a
    label are compared as one and count as many; each links with all its copies, also where an id is repeated. An empty
    table gives no rows. The threshold lies in (0, 1].
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    fit = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    classes = cut(fit.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each block and strip in which a vector is compared; at home in its own, a guest in the next."""
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.array([len(x) for x in lists])
            for dim in np.unique(sizes):
                some = batch.filter(pa.array(sizes == dim))
                v = as_matrix(some.column("vector"))
                scale = np.abs(v).max(axis=1, keepdims=True)  # squares of very large numbers would overflow
                v = v / scale
                v = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ rotation(int(dim))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, dim), pa.int32()), pa.array(v.ravel()))
                for k, (at, most) in enumerate(zip(blocks(int(dim)), budgets(int(dim), threshold), strict=True)):
                    strip = np.floor(v[:, at[0]] / np.sqrt(most)).astype(np.int64)
                    for guest in (False, True):
                        yield pa.RecordBatch.from_arrays(
                            [
                                some.column("label").cast(pa.string()),
                                pa.array(np.full(len(v), dim, np.int32)),
                                pa.array(np.full(len(v), k, np.int32)),
                                pa.array(strip + guest),
                                pa.array(np.full(len(v), not guest)),
                                some.column("id"),
                                some.column("copies"),
                                flat,
                            ],
                            names=["label", "dim", "block", "strip", "home", "id", "copies", "vector"],
                        )

    placed = classes.mapInArrow(
        turn, "label string, dim int, block int, strip long, home boolean, id long, copies long, vector array<double>"
    )
    keys = ["label", "dim", "block", "strip"]
    parts = cut(placed.groupBy(*keys).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")))
    placed = placed.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    met = placed.select(*keys, "home", "id", "copies", "vector", "part", other).select(
        *keys, "home", "id", "copies", "vector", "part", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second")
    )

    def compare(group: pa.Table) -> pa.Table:
        part, first, second = (group[c].to_numpy() for c in ("part", "first", "second"))
        v, home, ids, copies = as_matrix(group["vector"]), group["home"].to_numpy(), group["id"].to_numpy(), group["copies"].to_numpy()
        a, b = np.flatnonzero(part == first[0]), np.flatnonzero(part == second[0])
        allowed = home[a][:, None] | home[b][None]
        if first[0] == second[0]:
            allowed &= np.arange(len(a))[:, None] < np.arange(len(b))[None]
        i, j = linked_pairs(v[a], v[b], allowed, int(group["block"][0].as_py()), threshold)
        i, j = a[i], b[j]
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        at = np.flatnonzero(links)
        return pa.table([ids[at], links[at].astype(np.int64), ids[roots(len(ids), i, j)[at]]], names=["id", "links", "root"])

    found = cut(met.groupBy(*keys, "first", "second").applyInArrow(compare, "id long, links long, root long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    merged = classes.select("label", "vector", "id", "copies").join(links, "id", "left").join(components, F.col("id") == F.col("node"), "left")
    told = merged.select("label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "id").alias("c"))
    return (
        rows.join(told, ["label", "vector"], "left")
        .select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("n")).alias("n"), F.when(F.col("vec_id").isNotNull(), F.col("c")).alias("c"))
        .select("vec_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )

"""Approximate nearest neighbours by largest inner product over randomly rotated one-bit codes.

A vector is divided by its norm, rotated at random and reduced to the signs of its coordinates. With the packed signs go
two scalars: the norm, and the inner product of the vector with its code. The code's inner product with a rotated query
divided by that scalar is an unbiased estimate with a known error bound. The query's coordinates are rounded to a few
bits, one packed plane per bit, so an estimate is a handful of AND and popcount operations on whole words. A candidate is
looked at exactly if the upper end of its estimate reaches the k-th best lower end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut

#: Width of the error bound in standard errors of the code's estimate.
ERRORS = 3.0
#: Bits of a query's coordinate; what rounding can change is added to the error bound.
QUERY_BITS = 6
#: Rows of a block of candidates, and of a block of queries, at about this share: blocks are dealt by a hash.
CANDIDATES, QUERIES = 16_384, 4_096
#: Queries that a task has estimates of at once.
TOGETHER = 64


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as words of 64."""
    n, dim = bits.shape
    padded = np.zeros((n, -(-dim // 64) * 64), bool)
    padded[:, :dim] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """One-bit codes of the rows of a matrix and what corrects them."""

    def __init__(self, vectors: np.ndarray):
        dim = vectors.shape[1]
        self.norm = np.linalg.norm(vectors, axis=1)
        turned = (vectors / self.norm[:, None]) @ rotation(dim)
        self.bits = pack(turned > 0)
        self.ones = np.bitwise_count(self.bits).sum(axis=1).astype(np.float64)
        self.fit = np.abs(turned).sum(axis=1) / np.sqrt(dim)  # inner product with the code, a unit vector
        self.spread = np.sqrt(np.maximum(1 - self.fit**2, 0)) / self.fit / np.sqrt(max(dim - 1, 1))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the inner products of queries (rows) with the coded vectors (columns)."""
        dim = queries.shape[1]
        turned = queries @ rotation(dim)
        low, top = turned.min(axis=1), turned.max(axis=1)
        step = np.maximum(top - low, 1e-300) / (2**QUERY_BITS - 1)
        level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        sums = np.zeros((len(queries), len(self.bits)))  # of the rounded coordinates where a code has a 1
        for j in range(QUERY_BITS):
            plane = pack((level >> j & 1).astype(bool))
            hits = np.zeros(sums.shape, np.uint16)
            for w in range(plane.shape[1]):
                hits += np.bitwise_count(plane[:, w, None] & self.bits[None, :, w])
            sums += (1 << j) * hits.astype(np.float64)
        # a code's coordinates are +-1/sqrt(dim): twice the sum over its ones, less the sum over all
        plus = step[:, None] * sums + low[:, None] * self.ones[None]
        every = step * level.sum(axis=1) + low * dim
        product = (2 * plus - every[:, None]) / np.sqrt(dim)
        rounding = np.linalg.norm(turned - (low[:, None] + step[:, None] * level), axis=1)
        length = np.linalg.norm(queries, axis=1)
        middle = product / self.fit * self.norm
        error = (ERRORS * length[:, None] * self.spread + rounding[:, None] / self.fit) * self.norm
        return middle - error, middle + error


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def as_matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def block_top(queries: pa.Table, block: pa.Table, k: int) -> pa.Table:
    """The k best of one block for each query of another: estimates, choice by bounds, exact products of the chosen."""
    if not len(queries) or not len(block):  # vectors of a length that the other side lacks
        return pa.table([np.zeros(0, t) for t in ("i8", "i8", "i8", "f8")], names=["query_row", "query_id", "vec_id", "score"])
    q, v = as_matrix(queries["vector"]), as_matrix(block["vector"])
    q_id, v_id = queries["id"].to_numpy(), block["id"].to_numpy()
    q_row, v_row = queries["row"].to_numpy(), block["row"].to_numpy()
    codes = Codes(v)
    out = []
    for a in range(0, len(q), TOGETHER):
        low, high = codes.bounds(q[a : a + TOGETHER])
        own = q_row[a : a + TOGETHER, None] == v_row[None]  # a query's own row is no candidate
        low[own] = high[own] = -np.inf
        kth = np.partition(low, max(low.shape[1] - k, 0), axis=1)[:, max(low.shape[1] - k, 0)]
        for i in range(len(low)):
            chosen = np.flatnonzero((high[i] >= kth[i]) & ~own[i])
            score = (v[chosen] * q[a + i]).sum(axis=1)
            best = np.lexsort((v_id[chosen], -score))[:k]
            out.append((np.full(len(best), q_row[a + i]), np.full(len(best), q_id[a + i]), v_id[chosen[best]], score[best]))
    return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], names=["query_row", "query_id", "vec_id", "score"])


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def search(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows (query_id, rank, vec_id, score) of every row for which `is_query` holds.

    Nearness is the inner product in double precision; ties go to the smaller id; fewer rows come back if there are fewer
    candidates. A query is compared with rows of its own length. Rows whose vector is null, empty, zero or has a null or
    non-finite component, or whose id is null, take no part. Rows that repeat an id are rows of their own: each is a
    candidate, but a row is never its own. An empty table gives no rows.

    Candidates and queries are dealt into blocks of bounded size by a hash of id and vector; every block of queries meets
    every block of candidates in a task of its own, which gives back at most k rows a query.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("is_query")).filter(
        F.col("id").isNotNull() & usable(F.col("vector"))
    )
    # repeated rows are told apart by where they stand; blocks of a third of all rows that are alike spread by it, too
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    n = rows.agg(F.count("*").alias("n"), F.sum(F.col("is_query").cast("long")).alias("q")).first()
    n_blocks, q_blocks = max(1, -(-n["n"] // CANDIDATES)), max(1, -(-(n["q"] or 0) // QUERIES))
    spread = F.xxhash64("id", "row")
    dim = F.size("vector").alias("dim")
    block, q_block = F.pmod(spread, F.lit(n_blocks)), F.pmod(spread, F.lit(q_blocks))
    candidates = rows.select(
        dim, block.alias("block"), F.explode(_numbers(q_blocks)).alias("q_block"), "id", "row", "vector"
    )
    queries = rows.filter("is_query").select(
        dim, F.explode(_numbers(n_blocks)).alias("block"), q_block.alias("q_block"), "id", "row", "vector"
    )
    keys = ["dim", "block", "q_block"]

    def meet(queries: pa.Table, block: pa.Table) -> pa.Table:
        return block_top(queries, block, k)

    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        meet, "query_row long, query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

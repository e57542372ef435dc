"""Sets of hashes as bitmaps of a fixed size, and the largest value of each cell of hashes. Both go to every worker.

Other hashes may share a bit or a cell, so what they let through is a superset: callers use them to move less, never to
decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import shuffles_end

#: 8 and 4 MB. Larger ones let less through on larger tables; results do not depend on them.
BITMAP_BITS, CELLS = 1 << 26, 1 << 22
_PART = 1 << 16


def hits(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap_of(hashes: DataFrame) -> bytes:
    """BITMAP_BITS bits with those set that the one column of hashes names; tasks fill a part of it each."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy().view(np.uint64) & np.uint64(BITMAP_BITS - 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at // _PART).astype(np.int32)), pa.array((at % _PART).astype(np.int32))], names=["part", "at"]
            )

    def fill(group: pa.Table) -> pa.Table:
        bits = np.zeros(_PART, bool)
        bits[group["at"].to_numpy()] = True
        return pa.table({"part": group["part"][:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    with shuffles_end(hashes.sparkSession):
        placed = hashes.mapInArrow(place, "part int, at int").distinct()
        rows = placed.groupBy("part").applyInArrow(fill, "part int, bits binary").collect()
    for row in rows:
        out[row["part"] * _PART // 8 : (row["part"] + 1) * _PART // 8] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def cells_of(values: DataFrame) -> bytes:
    """CELLS bytes: the largest value (1 to 255) that (hash, value) rows put into each cell, 0 where none does."""
    cell = F.pmod(F.col("hash"), F.lit(CELLS))
    largest = values.groupBy(cell.alias("cell")).agg(F.max("value").alias("value"))

    def fill(group: pa.Table) -> pa.Table:
        cells = np.zeros(_PART, np.uint8)
        cells[group["cell"].to_numpy() % _PART] = group["value"].to_numpy()
        return pa.table({"part": group["part"][:1], "cells": pa.array([cells.tobytes()], pa.binary())})

    out = np.zeros(CELLS, np.uint8)
    with shuffles_end(values.sparkSession):
        placed = largest.withColumn("part", F.floor(F.col("cell") / _PART).cast("int"))
        rows = placed.groupBy("part").applyInArrow(fill, "part int, cells binary").collect()
    for row in rows:
        out[row["part"] * _PART : (row["part"] + 1) * _PART] = np.frombuffer(row["cells"], np.uint8)
    return out.tobytes()


def values_of(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return cells[(hashes & np.uint64(len(cells) - 1)).astype(np.int64)]

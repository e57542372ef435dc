"""Reading tables, cutting lineage and looking at Arrow strings as bytes."""

from __future__ import annotations

import atexit
import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that a task turns into arrays at once. A single longer text is one piece of its own.
PIECE_BYTES = 1 << 20
_STORED: list[tuple[SparkSession, str]] = []
_ON_THE_WAY: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("_ON_THE_WAY", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A to Z only: other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def stored(frame: DataFrame, compression: str = "snappy") -> DataFrame:
    """The frame as a Parquet table in the same folder as `cut` uses, deleted when the application ends.

    For rows that go through many joins, one after another: unlike a checkpoint the table carries nothing over from the
    plan that made it. (What the optimizer infers about columns grows by each join, and a checkpoint keeps it.) Shuffle files
    of the write go with it.
    """
    spark = frame.sparkSession
    path = f"{_folder(spark).rstrip('/')}/marketlens-{uuid.uuid4().hex}"
    with shuffles_end(spark):
        frame.write.parquet(path, compression=compression)
    _STORED.append((spark, path))
    if (made := _ON_THE_WAY.get()) is not None:
        made.append((spark, path))
    return spark.read.schema(frame.schema).parquet(path)


def finished(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """`build`, with its rows stored; tables that it stored on the way go then, and not only when the application ends."""

    @functools.wraps(build)
    def run(*args, **named) -> DataFrame:
        made: list[tuple[SparkSession, str]] = []
        outer = _ON_THE_WAY.set(made)
        try:
            try:
                frame = build(*args, **named)
            finally:
                _ON_THE_WAY.reset(outer)
            return stored(frame)
        finally:
            _delete(made)
            _STORED[:] = [x for x in _STORED if x not in made]

    return run


@contextlib.contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is built and run here leaves no shuffle files; else they stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark 4.1; without effect before
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _delete(tables: list[tuple[SparkSession, str]]) -> None:
    for spark, path in tables:
        with contextlib.suppress(Exception):  # the session may have ended before
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@atexit.register
def _delete_stored() -> None:
    _delete(_STORED)


def cut(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder of `spark.checkpoint.dir`, so that a lost executor costs no recomputation
    and rows are the same each time they are read. Only a local session without that setting gets a folder of its own."""
    _folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def _folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir names no folder that all executors share")
            named = tempfile.mkdtemp(prefix="marketlens-checkpoint-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more offset than texts). A null is empty."""
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        width = np.int64
    else:
        width = np.int32
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    begin = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[begin[0] : begin[-1]], begin - begin[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about `most` bytes of text, so that arrays per byte stay small."""
    _, begin = as_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(begin, begin[first] + most, "right")) - 1
        last = max(first + 1, min(last, batch.num_rows))
        yield batch.slice(first, last - first)
        first = last


def as_strings(texts: pa.Array) -> list[str]:
    """Python strings; a null is empty and bytes that are no UTF-8 become U+FFFD."""
    try:
        return ["" if x is None else x for x in texts.to_pylist()]
    except UnicodeDecodeError:
        raw = texts.cast(pa.binary()).to_pylist()
        return ["" if x is None else x.decode("utf-8", "replace") for x in raw]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves about half of the output's bits."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

"""Landed bar files, long or wide, and giving bars their ids."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens import schemas
from marketlens.functions.placement import as_date, keep_members

# fixed value: first day that a daily download asks for; give it as `start` to leave out what is older
HISTORY_START = dt.date(2024, 1, 1)

PRICE_FIELDS = ("open", "high", "low", "close")
BAR_FIELDS = (*PRICE_FIELDS, "volume")


def scan_bars(
    bars: DataFrame,
    tickers: Sequence[str] | None = None,
    start: dt.date | str | Column | None = None,
    end: dt.date | str | Column | None = None,
) -> DataFrame:
    """Bars of the given symbols with start <= date < end; both bounds reach the file scan.

    Without bounds and symbols that is all of them.
    """
    if start is not None:
        bars = bars.filter(F.col("date") >= as_date(start))
    if end is not None:
        bars = bars.filter(F.col("date") < as_date(end))
    return bars if tickers is None else keep_members(bars, tickers)


def read_landed(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    tickers: Sequence[str] | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Landed long bars, read under a fixed schema."""
    reader = spark.read.schema(schemas.LANDED_BARS)
    if file_format == "csv":
        reader = reader.option("header", True)
    return scan_bars(reader.format(file_format).load(path), tickers, start, end)


def _plain(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def wide_to_long(wide: DataFrame, date_column: str = "Date", drop_empty_bars: bool = True) -> DataFrame:
    """Turn one row per date with ``<ticker>_<Field>`` columns into one row per (date, ticker).

    Each wide row is expanded where it lies, so nothing is shuffled. Prices are
    taken as already adjusted: the adjusted close is the close. Every column but
    the date must name a ticker and a field of a bar; others are an error.
    """
    columns: dict[str, dict[str, str]] = {}
    unknown = []
    for name in wide.columns:
        if name == date_column:
            continue
        ticker, sep, field = name.rpartition("_")
        if sep and ticker and _plain(field) in BAR_FIELDS:
            columns.setdefault(ticker, {})[_plain(field)] = name
        else:
            unknown.append(name)
    if unknown:
        raise ValueError(f"not <ticker>_<Field> of a bar: {unknown}")

    def cell(have: dict[str, str], field: str) -> Column:
        kind = "long" if field == "volume" else "double"
        source = F.col(f"`{have[field]}`") if field in have else F.lit(None)
        return source.cast(kind).alias(field)

    bars = [
        F.struct(F.lit(t).alias("ticker"), *[cell(have, f) for f in BAR_FIELDS])
        for t, have in sorted(columns.items())
    ]
    if not bars:
        raise ValueError("no <ticker>_<Field> columns found")
    long = wide.select(
        F.to_date(F.col(f"`{date_column}`")).alias("date"), F.inline(F.array(*bars))
    )
    if drop_empty_bars:
        long = long.filter(F.coalesce(*[F.col(f).cast("double") for f in BAR_FIELDS]).isNotNull())
    return long.select(
        "ticker", "date", *PRICE_FIELDS, F.col("close").alias("adj_close"), "volume"
    )


def with_bar_ids(bars: DataFrame, after: int, ingested_at: dt.datetime | None = None) -> DataFrame:
    """Number landed bars above ``after`` and stamp them, in the shape of bronze.

    Numbers follow the order in which the files are read and have gaps. They need
    no shuffle, and a retried task of a file scan hands out the same ones again.
    One batch spends 2**33 numbers per task, which leaves room for thousands of
    batches of a hundred thousand tasks each.
    """
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    numbered = bars.withColumn("id", F.monotonically_increasing_id() + F.lit(after + 1))
    return numbered.withColumn("ingested_at", stamp).select(*schemas.BRONZE_BARS.fieldNames())

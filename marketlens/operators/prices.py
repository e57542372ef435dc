"""Deduplicating raw bars, and moving old ones to the archive.

Raw bars may repeat a (date, ticker) any number of times, and one ticker or one
day may hold a large share of them. The newest bar is therefore chosen by an
aggregate over fixed-width columns: each task first reduces its own input to one
row per (date, ticker), so a hot key shrinks before the shuffle and no task ever
holds all of its copies.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.placement import as_date
from marketlens.params import RiskParams

BAR_KEY = ("date", "ticker")


def dedup_bars(bars: DataFrame) -> DataFrame:
    """Keep, whole, the bar with the highest id of each (date, ticker).

    Ids must differ within a (date, ticker); bronze ids always do.
    """
    payload = [c for c in bars.columns if c not in (*BAR_KEY, "id")]
    newest = bars.groupBy(*BAR_KEY).agg(
        F.max("id").alias("id"),
        *[F.max_by(c, "id").alias(c) for c in payload],
    )
    return newest.select(*bars.columns)


def clean_prices(bars: DataFrame) -> DataFrame:
    """One (date, ticker, adj_close, volume) per key, from the newest bar."""
    return bars.groupBy(*BAR_KEY).agg(
        F.max_by("adj_close", "id").alias("adj_close"),
        F.max_by("volume", "id").alias("volume"),
    )


def archive_cutoff(as_of: dt.date | str | Column, params: RiskParams = RiskParams()) -> Column:
    return F.date_sub(as_date(as_of), params.retention_days)


def rows_to_archive(
    bars: DataFrame, as_of: dt.date | str | Column, params: RiskParams = RiskParams()
) -> DataFrame:
    """Bars older than the retention period."""
    return bars.filter(F.col("date") < archive_cutoff(as_of, params))


def rows_to_retain(
    bars: DataFrame, as_of: dt.date | str | Column, params: RiskParams = RiskParams()
) -> DataFrame:
    """Bars that stay in bronze."""
    return bars.filter(F.col("date") >= archive_cutoff(as_of, params))


def dedupe_archive(archive: DataFrame) -> DataFrame:
    """The archive receives the same bar again on every re-fetch; this undoes that.

    A bar can be archived twice under one id, so exact copies go first.
    """
    return dedup_bars(archive.dropDuplicates())

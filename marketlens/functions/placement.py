"""Where small inputs go, and how a clock value is read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A date column can take at most this many values (0001-01-01 to 9999-12-31).
CALENDAR_ROWS = 3_652_059

# Member lists up to this length become a filter that can reach the file scan ...
IN_LIST_ROWS = 1_000
# ... and up to this length are sent to every executor; longer ones are shuffled.
MEMBER_LIST_ROWS = 100_000


def broadcast_calendar(per_date: DataFrame) -> DataFrame:
    """Hint a frame that holds at most one row per calendar date.

    Callers pass frames that are unique on ``date`` by construction, so the size
    is bounded by CALENDAR_ROWS whatever the number of tickers: a century of
    trading days is about 25,000 rows.
    """
    return F.broadcast(per_date)


def keep_members(df: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Rows whose ticker is in the list; the list's length is known and checked."""
    distinct = sorted(set(tickers))
    if len(distinct) <= IN_LIST_ROWS:
        return df.filter(F.col("ticker").isin(distinct))
    members = df.sparkSession.createDataFrame([(t,) for t in distinct], "ticker string")
    if len(distinct) <= MEMBER_LIST_ROWS:
        members = F.broadcast(members)
    return df.join(members, "ticker", "left_semi")


def as_time(value: dt.date | dt.datetime | str | Column) -> Column:
    """A moment given as a timestamp, a date (its midnight), an ISO string or a column."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(str(value)).cast("timestamp")


def as_date(value: dt.date | str | Column) -> Column:
    """A clock value given as a date, an ISO string or a column."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")

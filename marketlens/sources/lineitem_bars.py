"""Daily bars derived from the line items of a star-schema sales database.

Half of the suppliers stand for the five indices, by their key's residue, and every
other supplier for a stock of its own, the first five for the watched ones: so the
tickers grow with the suppliers. The ship date is the trading day, and quantity and
discount make the price. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# fixed values: symbol of each residue of the supplier key modulo 10, for indices of
# every supplier with that residue, for stocks of the first one
SYMBOLS = ("^GSPC", "^VIX", "^IXIC", "^TNX", "^IRX", "NVDA", "TSLA", "XOM", "CVX", "PG")
INDICES = 5


def bars_from_lineitem(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """The bars, and ``more`` columns of the line items beside them."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    residue = (F.col("l_suppkey") % 10).cast("int")
    named = F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), residue + 1)
    own = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    ticker = F.when((residue < INDICES) | (F.col("l_suppkey") < 10), named).otherwise(own)
    # order number, line and part: grows with the order number, and differs
    # between the bars of one symbol and day
    bar_id = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + (
        F.col("l_partkey") % 1_000_000
    )
    close = F.when(residue == 1, 10.0 + F.col("l_orderkey") % 26).otherwise(
        100.0 + F.col("l_quantity") + F.col("l_discount")
    )
    return items.select(
        bar_id.alias("id"),
        ticker.alias("ticker"),
        F.to_date("l_shipdate").alias("date"),
        close.alias("open"),
        (close + 1).alias("high"),
        (close - 1).alias("low"),
        close.alias("close"),
        close.alias("adj_close"),
        F.floor("l_extendedprice").cast("long").alias("volume"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        *more,
    )

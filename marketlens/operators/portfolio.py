"""Portfolio stress and stocks that move on their own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from marketlens.functions.placement import MEMBER_LIST_ROWS
from marketlens.functions.safe_math import safe_exp, safe_ln
from marketlens.params import RiskParams

DEFAULTS = RiskParams()

# Weights of named portfolios: portfolio -> ticker -> weight.
Portfolios = Mapping[str, Mapping[str, float]]


# Portfolios of one ticker that are joined together; a ticker that more of them hold is dealt out.
HOLDERS_TOGETHER = 2_000


def portfolio_stress(
    returns: DataFrame, portfolios: Portfolios, params: RiskParams = DEFAULTS
) -> DataFrame:
    """Each portfolio's worst loss over ``compounding`` rows, and the date that ended it.

    A portfolio has a return on the dates on which all its members have one, so it
    has at most one row per calendar day.
    """
    rows = [(name, ticker, float(weight), len(members)) for name, members in portfolios.items() for ticker, weight in members.items()]
    weights = returns.sparkSession.createDataFrame(rows, "portfolio string, ticker string, weight double, members long")
    if len(rows) <= MEMBER_LIST_ROWS:
        weights = F.broadcast(weights)
    moves = returns.filter(F.col("daily_return").isNotNull())
    return _worst_falls(moves.join(weights, "ticker"), params)


def portfolio_stress_of(returns: DataFrame, weights: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """The same for a table of weights (portfolio, ticker, weight), of any number of portfolios.

    Portfolios that hold the same are worked out once. A portfolio has a return only on
    the days of its member with the fewest, so the rows begin with that member's days,
    and the others' returns are looked up by ticker and date: a ticker that all
    portfolios hold gives them no days of its own. Those that share such a first member
    are dealt into parts of ``HOLDERS_TOGETHER`` at about, and the member's returns go to
    each part. Rows that repeat a portfolio and ticker add up to one member; rows
    without portfolio, ticker or weight are left out.
    """
    held = weights.dropna(subset=["portfolio", "ticker", "weight"]).groupBy("portfolio", "ticker").agg(F.sum("weight").alias("weight"))
    baskets = held.groupBy("portfolio").agg(F.sort_array(F.collect_list(F.struct("ticker", "weight"))).alias("basket"))
    leads = baskets.groupBy("basket").agg(F.min("portfolio").alias("lead"))
    moves = returns.filter(F.col("daily_return").isNotNull()).select("date", "ticker", "daily_return")
    days = moves.groupBy("ticker").agg(F.count("*").alias("days"))
    members = leads.select("lead", F.size("basket").cast("long").alias("members"), F.inline("basket"))
    rarest = (
        members.join(days, "ticker", "left")
        .groupBy("lead")
        .agg(F.min(F.struct(F.coalesce("days", F.lit(0).cast("long")).alias("days"), "ticker", "weight", "members")).alias("m"))
        .select("lead", "m.*")
        .filter("days > 0")
    )
    parts = rarest.groupBy("ticker").agg(F.ceil(F.count("*") / F.lit(HOLDERS_TOGETHER)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("lead"), F.col("parts")).cast("int")
    # a number of tasks of its own: how small the rows are says nothing of the days that come of them
    tasks = 2 * int(returns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rarest.join(parts, "ticker").select("lead", "ticker", "weight", "members", part.alias("part")).repartition(tasks, "ticker", "part")
    first = moves.join(parts, "ticker").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    begun = first.join(dealt.hint("merge"), ["ticker", "part"]).select("lead", "date", "members", "weight", "daily_return")
    others = members.join(rarest.select("lead", "ticker"), ["lead", "ticker"], "left_anti").select("lead", "ticker", F.col("weight"))
    asked = begun.filter("members > 1").select("lead", "date", "members").join(others, "lead")
    looked_up = moves.join(others.select("ticker").distinct(), "ticker", "left_semi")
    more = asked.join(looked_up, ["ticker", "date"]).select("lead", "date", "members", "weight", "daily_return")
    falls = _worst_falls(begun.unionByName(more).withColumnRenamed("lead", "portfolio"), params)
    named = baskets.join(leads, "basket").select("portfolio", "lead")
    return named.join(falls.withColumnRenamed("portfolio", "lead"), "lead").drop("lead")


def _worst_falls(shares: DataFrame, params: RiskParams) -> DataFrame:
    """From what each member of a portfolio moved on a date, with its weight and the number of members."""
    span = params.compounding
    by_date = Window.partitionBy("portfolio").orderBy("date")
    last = by_date.rowsBetween(-(span - 1), Window.currentRow)
    growth = F.sum(safe_ln(1 + F.col("portfolio_return"))).over(last)
    return (
        shares.groupBy("portfolio", "date")
        .agg(
            F.sum(F.col("weight") * F.col("daily_return")).alias("portfolio_return"),
            F.count("*").alias("present"),
            F.max("members").alias("members"),
        )
        .filter("present = members")
        .withColumn("loss", safe_exp(growth) - 1)
        .withColumn("seen", F.row_number().over(by_date))
        .filter(F.col("seen") >= span)
        .groupBy("portfolio")
        .agg(
            F.count("*").alias("windows"),
            F.min("loss").alias("worst_return_5d"),
            F.min_by("date", F.struct("loss", "date")).alias("worst_date"),
        )
    )


def idiosyncratic_divergence(
    panel: DataFrame,
    flat_within: float = 0.02,
    sigmas: float = 2.0,
    params: RiskParams = DEFAULTS,
) -> DataFrame:
    """Moves that neither the market nor the volatility index explains.

    Taken on days the index hardly moved. The residual is the return less beta
    times the market's return; it stands out beyond ``sigmas`` of the ticker's
    rolling daily volatility.
    """
    daily_sigma = F.col("annualized_volatility_30d") / F.sqrt(F.lit(float(params.trading_days)))
    return (
        panel.filter(
            F.col("has_return")
            & F.col("has_beta_row")
            & (F.abs("vix_return") <= flat_within)
        )
        .withColumn("residual", F.col("daily_return") - F.col("beta_30d") * F.col("mkt_return"))
        .filter(F.col("residual").isNotNull())
        .select(
            "date",
            "ticker",
            "daily_return",
            "residual",
            daily_sigma.alias("daily_sigma"),
            (F.abs("residual") > sigmas * daily_sigma).alias("diverges"),
        )
    )

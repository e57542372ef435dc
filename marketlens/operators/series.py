"""Per-ticker time series: returns, volatility, beta, drift, drawdown, regimes.

Clean prices hold one row per ticker and calendar day, so a per-ticker window
holds at most one row per day of history, however skewed the raw bars were.
Every window here is partitioned by ticker (or by ticker and a flag), so one
hash exchange on ticker serves a whole chain of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from marketlens.functions.placement import broadcast_calendar
from marketlens.functions.safe_math import safe_div, safe_exp, safe_ln, safe_sqrt
from marketlens.params import RiskParams

DEFAULTS = RiskParams()


def _by_date(*partition: str | Column) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy("date")


def _last(rows: int, *partition: str | Column) -> WindowSpec:
    return _by_date(*partition).rowsBetween(-(rows - 1), Window.currentRow)


def _after_warmup(value: Column, usable: str, params: RiskParams) -> Column:
    """NULL until ``min_periods`` usable rows were seen, if that is asked for."""
    if params.min_periods is None:
        return value
    return F.when(F.col(usable) >= params.min_periods, value)


# --------------------------------------------------------------------------- returns


def daily_returns(clean: DataFrame) -> DataFrame:
    """Change against the ticker's previous row; the first row has none."""
    previous = F.lag("adj_close").over(_by_date("ticker"))
    return clean.select(
        "date",
        "ticker",
        "adj_close",
        (safe_div(F.col("adj_close"), previous) - 1).alias("daily_return"),
    )


# Window sums get a name first and are combined afterwards, so that each is computed once.


def _return_sums(*partition: str, params: RiskParams) -> dict[str, Column]:
    r = F.col("daily_return")
    frame = _last(params.window, *partition)
    sums = {"sum_r": F.sum(r).over(frame), "sum_rr": F.sum(r * r).over(frame)}
    if params.min_periods is not None:
        sums["n_r"] = F.count(r).over(frame)
    return sums


def _volatility(params: RiskParams) -> Column:
    total, squares = F.col("sum_r"), F.col("sum_rr")
    # divisors stay fixed while the window is filling
    variance = (squares - total * total / params.window) / (params.window - 1)
    annual = safe_sqrt(variance) * F.sqrt(F.lit(float(params.trading_days)))
    return _after_warmup(annual, "n_r", params)


def _compounded(*partition: str, params: RiskParams) -> Column:
    frame = _last(params.compounding, *partition)
    return safe_exp(F.sum(safe_ln(1 + F.col("daily_return"))).over(frame)) - 1


def rolling_volatility(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Annualised volatility over the last rows that have a return."""
    return (
        returns.filter(F.col("daily_return").isNotNull())
        .withColumns(_return_sums("ticker", params=params))
        .select("date", "ticker", _volatility(params).alias("annualized_volatility_30d"))
    )


def cumulative_return(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Compounded return over the last rows that have a return."""
    compounded = _compounded("ticker", params=params)
    return returns.filter(F.col("daily_return").isNotNull()).select(
        "date", "ticker", "daily_return", compounded.alias("cumulative_return_5d")
    )


# ------------------------------------------------------------------------------ beta


def market_returns(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """The market's own series: (date, mkt_return), one row per date."""
    market = returns.filter(F.col("ticker") == params.market)
    return market.groupBy("date").agg(F.max("daily_return").alias("mkt_return"))


def _pair_sums(*partition: str, params: RiskParams) -> dict[str, Column]:
    # A row may lack the stock's return and still have the market's. It keeps its
    # slot in the window and counts in the market sums, so these are raw sums and
    # not a regression aggregate, which would leave such a row out altogether.
    stock, market = F.col("daily_return"), F.col("mkt_return")
    frame = _last(params.window, *partition)
    sums = {
        "sum_s": F.sum(stock).over(frame),
        "sum_m": F.sum(market).over(frame),
        "sum_sm": F.sum(stock * market).over(frame),
        "sum_mm": F.sum(market * market).over(frame),
    }
    if params.min_periods is not None:
        sums["n_sm"] = F.count(stock * market).over(frame)
    return sums


def _beta(params: RiskParams) -> Column:
    n = float(params.window)
    covariance = F.col("sum_sm") - F.col("sum_s") * F.col("sum_m") / n
    variance = F.col("sum_mm") - F.col("sum_m") * F.col("sum_m") / n
    return _after_warmup(safe_div(covariance, variance), "n_sm", params)


def rolling_beta(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Beta against the market over the last dates both have; the market itself is left out."""
    market = broadcast_calendar(market_returns(returns, params))
    return (
        returns.filter(F.col("ticker") != params.market)
        .join(market, "date")
        .withColumns(_pair_sums("ticker", params=params))
        .select("date", "ticker", _beta(params).alias("beta_30d"))
    )


def beta_drift(beta: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """How far beta moves over the next rows that have one."""
    ahead = F.lead("beta_30d", params.lead).over(_by_date("ticker"))
    return (
        beta.filter(F.col("beta_30d").isNotNull())
        .withColumn("beta_30d_5d_ahead", ahead)
        .withColumn("beta_30d_drift_5d", F.col("beta_30d_5d_ahead") - F.col("beta_30d"))
    )


# ------------------------------------------------------------------ prices and volume


def max_drawdown(clean: DataFrame) -> DataFrame:
    """Deepest fall below the running peak, in percent, with the highest peak and lowest price."""
    so_far = _by_date("ticker").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    price, peak = F.col("adj_close"), F.col("peak")
    return (
        clean.select("ticker", "date", "adj_close", F.max("adj_close").over(so_far).alias("peak"))
        .groupBy("ticker")
        .agg(
            F.min(safe_div(price - peak, peak) * 100).alias("max_drawdown_pct"),
            F.max(peak).alias("cycle_high"),
            F.min(price).alias("cycle_low"),
        )
    )


def drawdown_parts(clean: DataFrame) -> DataFrame:
    """Peak, lowest price and deepest fall of each ticker and year by itself, out of which ``merge_drawdowns`` makes the whole.

    A ticker's years lie in different tasks. Prices are above 0; those that are not take no part.
    """
    so_far = Window.partitionBy("ticker", "year").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    price = F.col("adj_close")
    return (
        clean.filter(price > 0)
        .withColumn("year", F.year("date"))
        .withColumn("so_far", F.max("adj_close").over(so_far))
        .groupBy("ticker", "year")
        .agg(
            F.min("date").alias("first"),
            F.max("adj_close").alias("peak"),
            F.min("adj_close").alias("trough"),
            F.min((price - F.col("so_far")) / F.col("so_far") * 100).alias("fall"),
        )
        .select("ticker", "first", "peak", "trough", "fall")
    )


def merge_drawdowns(parts: DataFrame, by: Column | str = "ticker") -> DataFrame:
    """The drawdown of each ticker out of parts that follow one another, of any lengths.

    The deepest fall lies within a part, or goes from the highest peak of the parts before to a part's trough: merged
    parts are parts again, so a day is a part that is merged with what there is.
    """
    earlier = Window.partitionBy(by).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    across = (F.col("trough") - F.col("before")) / F.col("before") * 100
    return (
        parts.withColumn("before", F.max("peak").over(earlier))
        .groupBy(by)
        .agg(
            F.min("first").alias("first"),
            F.max("peak").alias("peak"),
            F.min("trough").alias("trough"),
            F.min(F.least("fall", across)).alias("fall"),
        )
    )


def drawdown_of(merged: DataFrame) -> DataFrame:
    """Merged parts in the shape of ``max_drawdown``."""
    return merged.select(
        "ticker", F.col("fall").alias("max_drawdown_pct"), F.col("peak").alias("cycle_high"), F.col("trough").alias("cycle_low")
    )


def rolling_volume(clean: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Mean volume over the last rows that have one."""
    frame = _last(params.window, "ticker")
    return clean.filter(F.col("volume").isNotNull()).select(
        "date", "ticker", "volume", F.avg("volume").over(frame).alias("rolling_volume_30d")
    )


def moving_averages(clean: DataFrame, spans: tuple[int, ...] = (20, 50)) -> DataFrame:
    """Simple moving averages of the price; NULL until a full span of prices was seen."""
    out = [F.col("date"), F.col("ticker"), F.col("adj_close")]
    for rows in spans:
        frame = _last(rows, "ticker")
        mean = F.avg("adj_close").over(frame)
        out.append(
            F.when(F.count("adj_close").over(frame) == rows, mean).alias(f"sma_{rows}")
        )
    return clean.select(*out)


# ---------------------------------------------------------------------------- regimes


def regime_code(level: Column, params: RiskParams = DEFAULTS) -> Column:
    return (
        F.when(level < params.quiet_below, 0)
        .when(level <= params.stress_above, 1)
        .when(level > params.stress_above, 2)
        .otherwise(3)
    )


def vix_regime(prices: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Regime of each date the volatility index has a level for."""
    return prices.filter(
        (F.col("ticker") == params.vix) & F.col("adj_close").isNotNull()
    ).select(
        "date",
        "adj_close",
        regime_code(F.col("adj_close"), params).alias("market_regime_vix"),
    )


# --------------------------------------------------------------------- everything once


# what the market and the volatility index did on a date
CONTEXT = ("has_market", "mkt_return", "has_vix", "vix_price", "vix_return")


def date_context(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """One row per date with what the market and the volatility index did that day."""
    is_market = F.col("ticker") == params.market
    is_vix = F.col("ticker") == params.vix
    r = F.col("daily_return")
    return (
        returns.filter(is_market | is_vix)
        .groupBy("date")
        .agg(
            F.max(is_market).alias("has_market"),
            F.max(F.when(is_market, r)).alias("mkt_return"),
            F.max(is_vix).alias("has_vix"),
            F.max(F.when(is_vix, F.col("adj_close"))).alias("vix_price"),
            F.max(F.when(is_vix, r)).alias("vix_return"),
        )
    )


def with_flags(rows: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Which rows of a (ticker, date) with its date's context have a return, and which take part in beta."""
    in_beta = F.coalesce("has_market", F.lit(False)) & (F.col("ticker") != params.market)
    return rows.withColumn("has_return", F.col("daily_return").isNotNull()).withColumn("has_beta_row", in_beta)


def panel_figures(rows: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Volatility, compounded return, beta and regime beside rows that have their flags and their date's context."""
    on_returns, on_market = ("ticker", "has_return"), ("ticker", "has_beta_row")
    level = F.col("vix_price")
    return (
        rows.withColumns(_return_sums(*on_returns, params=params))
        .withColumn("compounded", _compounded(*on_returns, params=params))
        .withColumns(_pair_sums(*on_market, params=params))
        .select(
            *rows.columns,
            F.when(F.col("has_return"), _volatility(params)).alias("annualized_volatility_30d"),
            F.when(F.col("has_return"), F.col("compounded")).alias("cumulative_return_5d"),
            F.when(F.col("has_beta_row"), _beta(params)).alias("beta_30d"),
            F.when(level.isNotNull(), regime_code(level, params)).alias("market_regime_vix"),
        )
    )


def risk_panel(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Every series figure of every (date, ticker), with a single shuffle of the returns.

    The single-figure operators above filter rows before they open a window, and
    combining them afterwards would mean one join per figure. Here the filter
    becomes a flag in the window's partition key instead: rows that qualify form
    one partition and see exactly the rows the filter would have left them. The
    hash exchange on ticker covers all of these keys.

    ``beta_30d`` is NULL where the row has no market date; use ``has_beta_row``
    to tell that from a beta that could not be computed.
    """
    context = broadcast_calendar(date_context(returns, params))
    rows = with_flags(returns.join(context, "date", "left"), params)
    figures = panel_figures(rows, params).withColumn("has_beta", F.col("beta_30d").isNotNull())
    ahead = F.lead("beta_30d", params.lead).over(_by_date("ticker", "has_beta"))
    return (
        figures.withColumn("beta_30d_5d_ahead", F.when(F.col("has_beta"), ahead))
        .withColumn("beta_30d_drift_5d", F.col("beta_30d_5d_ahead") - F.col("beta_30d"))
        .drop("has_beta", "has_market")
    )

"""The datasets behind the reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions.placement import as_time, keep_members
from marketlens.params import RiskParams

DEFAULTS = RiskParams()

# fixed values: regime labels by code
REGIME_LABELS = {0: "Quiet (Low Volatility)", 1: "Standard (Moderate Risk)"}
REGIME_LABEL_OTHERWISE = "Stress (High Risk/Panic)"

# fixed values: quadrant labels by (high beta, high VaR)
QUADRANTS = {
    (True, True): "High Beta / High VaR (Aggressive)",
    (True, False): "High Beta / Low VaR (Efficient)",
    (False, True): "Low Beta / High VaR (Outlier Risk)",
    (False, False): "Low Beta / Low VaR (Defensive)",
}


def _has_panel_row() -> Column:
    return F.col("has_return") & F.col("has_beta_row")


def stock_risk_panel(panel: DataFrame) -> DataFrame:
    """Volatility, beta and price of every ticker on every day that has all three rows."""
    return panel.filter(_has_panel_row()).select(
        "date", "ticker", "annualized_volatility_30d", "beta_30d", "adj_close"
    )


def stock_panic_panel(panel: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """The same with that day's volatility index and whether it was a day of panic."""
    return panel.filter(_has_panel_row() & F.col("has_vix")).select(
        "date",
        "ticker",
        "annualized_volatility_30d",
        "beta_30d",
        "adj_close",
        "vix_price",
        F.coalesce(F.col("vix_price") >= params.panic_at, F.lit(False)).alias("panic"),
    )


def panic_periods(clean: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Unbroken runs of days on which the volatility index was at panic level.

    The index has one row per day, so its one window is as long as the calendar.
    """
    by_date = Window.partitionBy("ticker").orderBy("date")
    by_state = Window.partitionBy("ticker", "panic").orderBy("date")
    return (
        clean.filter(F.col("ticker") == params.vix)
        .withColumn("panic", F.coalesce(F.col("adj_close") >= params.panic_at, F.lit(False)))
        # both counts advance together inside a run and part company between runs
        .withColumn("run", F.row_number().over(by_date) - F.row_number().over(by_state))
        .filter("panic")
        .groupBy("run")
        .agg(
            F.min("date").alias("period_start"),
            F.max("date").alias("period_end"),
            F.count("*").alias("days"),
            F.max("adj_close").alias("peak_vix"),
        )
        .drop("run")
    )


def regime_label(code: Column) -> Column:
    label = F.lit(REGIME_LABEL_OTHERWISE)
    for value, text in REGIME_LABELS.items():
        label = F.when(code == value, F.lit(text)).otherwise(label)
    return label


def latest_regime(regimes: DataFrame) -> DataFrame:
    """The volatility index's newest level and the name of its regime, in one row."""
    return regimes.agg(
        F.max("date").alias("date"),
        F.max_by("adj_close", "date").alias("current_level"),
        F.max_by("market_regime_vix", "date").alias("market_regime_vix"),
    ).select("*", regime_label(F.col("market_regime_vix")).alias("regime_label"))


def risk_matrix(
    latest_var: DataFrame, latest_predictions: DataFrame, universe: Sequence[str]
) -> DataFrame:
    """Beta forecast against VaR for the universe, in quadrants around the medians.

    The medians are one aggregate over the universe; every point is compared with
    them where it lies.
    """
    points = (
        keep_members(latest_var, universe)
        .join(latest_predictions, "ticker")
        .select(
            "ticker",
            F.col("monte_carlo_var").alias("mc_var"),
            F.col("predicted_beta_final").alias("pred_beta"),
            "forecast_date",
        )
    )
    middle = points.agg(F.struct(F.median("pred_beta").alias("beta"), F.median("mc_var").alias("var"))).scalar()
    high_beta = F.col("pred_beta") > middle.getField("beta")
    high_var = F.col("mc_var") > middle.getField("var")
    return points.withColumn(
        "risk_category",
        F.when(high_beta & high_var, QUADRANTS[True, True])
        .when(high_beta & ~high_var, QUADRANTS[True, False])
        .when(~high_beta & high_var, QUADRANTS[False, True])
        .otherwise(QUADRANTS[False, False]),
    )


def forecast_panel(forecast: DataFrame, spotlight: Sequence[str]) -> DataFrame:
    """Current and forecast beta of the spotlight tickers, from rows with a ``predicted_drift``."""
    current = F.col("feat_rolling_beta_130d")
    return keep_members(forecast, spotlight).select(
        "ticker",
        "date",
        current.alias("current_beta"),
        (current + F.col("predicted_drift")).alias("forecast_beta"),
    )


def quality_gate(
    forecast: DataFrame, as_of: dt.date | dt.datetime | str | Column, params: RiskParams = DEFAULTS
) -> DataFrame:
    """One row that says what is wrong with a forecast; the caller decides what to do about it.

    Missing predictions are failures, extreme betas are warnings. A forecast is
    stale if its latest day, taken at midnight, lies more than ``stale_after_hours``
    before the moment ``as_of``.
    """
    oldest_fresh = as_time(as_of) - F.make_dt_interval(hours=F.lit(params.stale_after_hours))
    return forecast.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("predicted_drift").isNull()).alias("null_predictions"),
        F.count_if(F.col("feat_rolling_beta_130d") > params.beta_limit).alias("extreme_betas"),
        F.max("date").alias("latest_date"),
    ).select(
        "*",
        F.coalesce(F.col("latest_date").cast("timestamp") < oldest_fresh, F.lit(True)).alias("stale"),
        (
            (F.col("null_predictions") == 0)
            & F.coalesce(F.col("latest_date").cast("timestamp") >= oldest_fresh, F.lit(False))
        ).alias("passed"),
    )

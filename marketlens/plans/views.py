"""The silver and gold layer as temporary views over bronze, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.functions.safe_math import register_safe_math
from marketlens.operators import features, prices, series, value_at_risk
from marketlens.params import RiskParams
from marketlens.schemas import TABLES
from marketlens.sources import tables


def layer(bronze: DataFrame, params: RiskParams = RiskParams()) -> dict[str, DataFrame]:
    """Every silver and gold relation that derives from bronze alone."""
    clean = prices.clean_prices(bronze)
    returns = series.daily_returns(clean)
    beta = series.rolling_beta(returns, params)
    return {
        "silver_price_history_clean": clean,
        "silver_returns": returns,
        "silver_rolling_volatility": series.rolling_volatility(returns, params),
        "gold_rolling_beta_30d": beta,
        "gold_max_drawdown": series.max_drawdown(clean),
        "gold_beta_30d_drift_5d": series.beta_drift(beta, params),
        "gold_cum_return_5d": series.cumulative_return(returns, params),
        "gold_market_regime_vix": series.vix_regime(clean, params),
        "gold_rolling_vol_30d": series.rolling_volume(clean, params),
    }


def register_views(
    spark: SparkSession,
    bronze: DataFrame,
    inference: DataFrame | None = None,
    var_summary: DataFrame | None = None,
    params: RiskParams = RiskParams(),
) -> list[str]:
    """(Re)create the views and the safe math functions; return the view names."""
    register_safe_math(spark)
    views = {"bronze_price_history": bronze, **layer(bronze, params)}
    if inference is not None:
        views["gold_risk_inference"] = inference
        views["gold_recent_risk_inference"] = features.latest_predictions(inference)
    if var_summary is not None:
        views["gold_risk_var_summary"] = var_summary
        views["gold_recent_risk_var_summary"] = value_at_risk.latest_var(var_summary)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def register_lake(spark: SparkSession, root: str, params: RiskParams = RiskParams()) -> list[str]:
    """Every stored table under ``root`` and every view over them, by name."""
    stored = {name: tables.read(spark, root, name) for name in TABLES}
    for name, df in stored.items():
        df.createOrReplaceTempView(name)
    views = register_views(
        spark,
        stored["bronze_price_history"],
        stored["gold_risk_inference"],
        stored["gold_risk_var_summary"],
        params,
    )
    return sorted({*stored, *views})

"""The feature table, matured metrics, and closing predictions with realised betas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketlens.params import RiskParams

KEY = ["ticker", "date"]

DEFAULTS = RiskParams()


def risk_features(panel: DataFrame) -> DataFrame:
    """Rows of the risk panel on which every model input is known.

    The columns called ``*_beta_130d`` hold the 30-row beta.
    """
    return panel.filter(
        F.col("has_return")
        & F.col("has_beta_row")
        & F.col("beta_30d").isNotNull()
        & F.col("market_regime_vix").isNotNull()
    ).select(
        "ticker",
        "date",
        F.col("annualized_volatility_30d").alias("feat_rolling_vol_30d"),
        F.col("beta_30d").alias("feat_rolling_beta_130d"),
        F.col("cumulative_return_5d").alias("feat_cumulative_return_5d"),
        F.col("market_regime_vix").cast("double").alias("feat_market_regime_vix"),
        F.col("beta_30d_drift_5d").alias("target_beta_drift_5d"),
    )


def upsert(existing: DataFrame, new: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """New rows replace existing ones with the same key; all others survive.

    Each side is read once: the rows of both are reduced to the newer one of a key.
    Keys are unique within either side, as they are in a stored table.
    """
    both = existing.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    rest = [c for c in existing.columns if c not in keys]
    newer = both.groupBy(*keys).agg(*[F.max_by(c, "_side").alias(c) for c in rest])
    return newer.select(*existing.columns)


def matured_metrics(
    features: DataFrame,
    existing: DataFrame | None = None,
    params: RiskParams = DEFAULTS,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Feature rows old enough for their target to be known and not yet in ``existing``.

    "Old enough" is: not after the date that has ``lead`` later dates in the table.
    With fewer dates than that there is no such date and nothing matures. If
    ``features`` and ``existing`` are some years of their tables, ``dates`` is the
    whole feature table, of which the dates are read.
    """
    last_matured = (
        (features if dates is None else dates).select("date").distinct().orderBy(F.desc("date")).offset(params.lead).limit(1)
    )
    rows = features.filter(F.col("date") <= last_matured.scalar())
    if existing is not None:
        rows = rows.join(existing.select(*KEY), KEY, "left_anti")
    return rows.select(
        "ticker",
        "date",
        F.col("feat_rolling_beta_130d").alias("actual_beta_130d"),
        F.col("feat_rolling_vol_30d").alias("actual_vol_30d"),
        F.col("feat_cumulative_return_5d").alias("actual_return_5d"),
        F.col("feat_market_regime_vix").cast("int").alias("vix_regime"),
    )


def backfill_actuals(
    predictions: DataFrame,
    beta: DataFrame,
    mode: str = "forward",
    params: RiskParams = DEFAULTS,
) -> DataFrame:
    """Fill missing realised betas and restate the error of every closed prediction.

    ``forward`` takes the beta ``lead`` rows after the forecast date, which is what
    a forecast that far ahead should be held against. ``as_coded`` takes the beta
    as many rows before it. Only open predictions are filled.
    """
    shift = {"forward": F.lead, "as_coded": F.lag}[mode]
    by_date = Window.partitionBy("ticker").orderBy("date")
    realised = beta.select(
        "ticker",
        F.col("date").alias("forecast_date"),
        shift("beta_30d", params.lead).over(by_date).alias("realised"),
    )
    return (
        predictions.join(realised, ["ticker", "forecast_date"], "left")
        .withColumn("actual_beta_realized", F.coalesce("actual_beta_realized", "realised"))
        .withColumn(
            "prediction_error",
            F.when(
                F.col("actual_beta_realized").isNotNull(),
                F.col("actual_beta_realized") - F.col("predicted_beta_final"),
            ).otherwise(F.col("prediction_error")),
        )
        .select(*predictions.columns)
    )


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """Per ticker, the last prediction made for the latest forecast date of the table.

    A ticker without a prediction for that date does not appear.
    """
    latest = predictions.agg(F.max("forecast_date")).scalar()
    newest = Window.partitionBy("ticker").orderBy(F.desc("prediction_id"))
    return (
        predictions.filter(F.col("forecast_date") == latest)
        .withColumn("pick", F.row_number().over(newest))
        .filter("pick = 1")
        .select(
            "ticker",
            "forecast_date",
            "prediction_id",
            "prediction_timestamp",
            "base_beta_130d",
            "predicted_drift",
            "predicted_beta_final",
            "model_version",
            "actual_beta_realized",
            "prediction_error",
        )
    )


def number_rows(df: DataFrame, name: str, keys: list[str], after: int, buckets: int = 1024) -> DataFrame:
    """Number rows densely above ``after``, the same way on any partitioning.

    ``keys`` must be unique. Rows are hashed on them into buckets, which are
    numbered side by side; only one count per bucket is brought together.
    """
    spread = df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spread.groupBy("bucket")
        .agg(F.count("*").alias("rows"))
        .select("bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    )
    within = F.row_number().over(Window.partitionBy("bucket").orderBy(*keys))
    return (
        spread.join(F.broadcast(starts), "bucket")  # at most `buckets` rows
        .withColumn(name, F.lit(after) + F.col("start") + within)
        .drop("bucket", "start")
    )

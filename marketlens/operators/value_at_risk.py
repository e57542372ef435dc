"""Value-at-Risk of every ticker at once, three ways.

Figures are signed returns: a loss is negative. ``params.loss_magnitude`` turns
them into positive losses.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions.safe_math import safe_div
from marketlens.params import RiskParams

DEFAULTS = RiskParams()

# fixed values: multiplier of a public 32-bit integer mixer, and its word
_MIXER = 0x45D9F3B
_WORD = 0xFFFFFFFF


def recent_returns(clean: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Returns of each ticker's last ``lookback`` rows; missing ones are dropped after the cut.

    One row more than the lookback is kept before the shuffle, since the oldest
    return needs the price before it. The rest of the history is not shuffled.
    """
    newest_first = Window.partitionBy("ticker").orderBy(F.desc("date"))
    return (
        clean.select("ticker", "date", "adj_close")
        .withColumn("age", F.row_number().over(newest_first))
        .filter(F.col("age") <= params.lookback + 1)
        .withColumn("previous", F.lead("adj_close").over(newest_first))
        .filter(F.col("age") <= params.lookback)
        .select(
            "ticker",
            "date",
            (safe_div(F.col("adj_close"), F.col("previous")) - 1).alias("daily_return"),
        )
        .filter(F.col("daily_return").isNotNull())
    )


def _signed(value: Column, params: RiskParams) -> Column:
    return -value if params.loss_magnitude else value


def _z(params: RiskParams) -> float:
    return NormalDist().inv_cdf(1 - params.confidence)


def _historical(params: RiskParams) -> Column:
    return F.percentile("daily_return", 1 - params.confidence)


def _parametric(params: RiskParams) -> Column:
    return F.avg("daily_return") + _z(params) * F.stddev_pop("daily_return")


def historical_var(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """The tail percentile of the returns, interpolated between neighbours."""
    return returns.groupBy("ticker").agg(
        _signed(_historical(params), params).alias("historical_var")
    )


def parametric_var(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """The tail percentile of a normal law with the returns' mean and population deviation."""
    return returns.groupBy("ticker").agg(
        _signed(_parametric(params), params).alias("parametric_var")
    )


def _streams(params: RiskParams) -> dict[str, Column]:
    """Where a ticker's two streams of random words start, from a hash of its name."""
    digest = F.md5(F.concat_ws("|", F.col("ticker"), F.lit(str(params.seed))))
    return {
        name: F.conv(F.substring(digest, first, 8), 16, 10).cast("long")
        for name, first in (("stream_u", 1), ("stream_v", 9))
    }


def _uniform(stream: str, draw: Column) -> Column:
    """Number ``draw`` of a stream, strictly between 0 and 1.

    The counter is scrambled in 32 bits; the products stay below 2**59.
    """
    word = (F.col(stream) + draw).bitwiseAND(F.lit(_WORD))
    for _ in range(2):
        word = (F.shiftright(word, 16).bitwiseXOR(word) * _MIXER).bitwiseAND(F.lit(_WORD))
    word = F.shiftright(word, 16).bitwiseXOR(word)
    return (word + 0.5) / float(_WORD + 1)


def _standard_normal() -> Column:
    """Box-Muller on the two streams: the same wherever it is computed."""
    draw = F.col("draw")
    radius = F.sqrt(-2.0 * F.ln(_uniform("stream_u", draw)))
    return radius * F.cos(2.0 * math.pi * _uniform("stream_v", draw))


def _simulate(moments: DataFrame, params: RiskParams) -> DataFrame:
    """Add to each row the tail percentile of ``draws`` simulated returns.

    A ticker's draws are spelled out, gathered and sorted in the task that holds
    the ticker, so they are never shuffled. Draws follow from the ticker alone and
    mean and deviation keep their order, so a ticker's rows share them. Tickers are
    spread over more tasks before that: they are far too small for their size to tell
    how much work each of them is, and left alone a few tasks would get them all.
    (The number is not that of the partitions they are in, or Spark would see nothing to do.)
    """
    tasks = 2 * int(moments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    position = (1 - params.confidence) * (params.draws - 1)
    below = math.floor(position)
    carried = [c for c in moments.columns if c != "ticker"]
    lower = F.col("mu") + F.col("sigma") * F.element_at("simulated", below + 1)
    upper = F.col("mu") + F.col("sigma") * F.element_at("simulated", min(below + 2, params.draws))
    return (
        moments.repartition(tasks, "ticker")
        .groupBy("ticker")
        .agg(F.collect_list(F.struct(*carried)).alias("carried"))
        .withColumns(_streams(params))
        .withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(params.draws - 1))))
        .withColumn("simulated", _standard_normal())
        .groupBy("ticker")
        .agg(F.first("carried").alias("carried"), F.sort_array(F.collect_list("simulated")).alias("simulated"))
        .select("ticker", "simulated", F.inline("carried"))
        .withColumn("monte_carlo", lower + (position - below) * (upper - lower))
        .drop("simulated")
    )


def _moments() -> list[Column]:
    return [
        F.avg("daily_return").alias("mu"),
        F.stddev_pop("daily_return").alias("sigma"),
    ]


def monte_carlo_var(returns: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """The tail percentile of returns drawn from a normal law, from seeded draws."""
    simulated = _simulate(returns.groupBy("ticker").agg(*_moments()), params)
    return simulated.select(
        "ticker", _signed(F.col("monte_carlo"), params).alias("monte_carlo_var")
    )


def var_figures(
    returns: DataFrame, timestamp: Column | None = None, params: RiskParams = DEFAULTS
) -> DataFrame:
    """What `var_summary` gives, but for the simulation, with the mean and deviation it needs.

    Rows of several runs may be put together and chosen from before `with_simulation`,
    so that only those wanted are simulated.
    """
    label = f"{params.confidence * 100:g}%% Daily VaR: %s%% (Historical)"
    # a decimal with its last places settled, so that ties go up in every engine
    percent = F.round(F.round(F.abs("historical_var") * 100, 8).cast("decimal(28,8)"), 2)
    return (
        returns.groupBy("ticker")
        .agg(
            *_moments(),
            F.max("date").alias("last_date"),
            _signed(_historical(params), params).alias("historical_var"),
            _signed(_parametric(params), params).alias("parametric_var"),
        )
        .select(
            "ticker",
            (F.current_timestamp() if timestamp is None else timestamp.cast("timestamp")).alias(
                "timestamp"
            ),
            "historical_var",
            "parametric_var",
            F.format_string(label, percent.cast("string")).alias("display_text"),
            "mu",
            "sigma",
        )
    )


def with_simulation(figures: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """Rows of `var_figures` with the simulated figure, in the columns of `var_summary`."""
    return _simulate(figures, params).select(
        "ticker",
        "timestamp",
        "historical_var",
        "parametric_var",
        _signed(F.col("monte_carlo"), params).alias("monte_carlo_var"),
        "display_text",
    )


def var_summary(
    returns: DataFrame, timestamp: Column | None = None, params: RiskParams = DEFAULTS
) -> DataFrame:
    """All three figures and a line of text per ticker, in one pass over the returns.

    ``timestamp`` may use ``last_date``, the date of the ticker's newest return.
    """
    return with_simulation(var_figures(returns, timestamp, params), params)


def latest_var(summaries: DataFrame) -> DataFrame:
    """Per ticker, the last summary of the table's latest day; others that day do not appear."""
    day = F.to_date("timestamp")
    latest = summaries.agg(F.max(day)).scalar()
    newest = Window.partitionBy("ticker").orderBy(F.desc("timestamp"))
    return (
        summaries.filter(day == latest)
        .withColumn("pick", F.row_number().over(newest))
        .filter("pick = 1")
        .drop("pick")
    )

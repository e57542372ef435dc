"""Features of a day's bars from what is carried over from the days before.

The state holds each ticker's newest rows with their prices, returns, figures and
their dates' context: enough for every window that a new row opens, and for the
targets of the rows just before it. A step takes the bars that have changed, new,
late or corrected, puts them among the ticker's rows and works out anew what lies
at or after the first of them; rows before that keep their figures, but for targets
that now reach a changed row. A change of the market or of the volatility index
concerns every ticker from its date on.

A ticker whose first change lies too far back for its state is ``deep``: it is
computed from its bars. Bars of other tickers are not read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from marketlens.functions.placement import broadcast_calendar
from marketlens.functions.safe_math import safe_div
from marketlens.operators import series
from marketlens.params import RiskParams
from marketlens.schemas import RISK_STATE

DEFAULTS = RiskParams()

_FIGURES = ("annualized_volatility_30d", "cumulative_return_5d", "beta_30d", "market_regime_vix")


def held_rows(params: RiskParams = DEFAULTS) -> int:
    """Rows of either kind that a ticker's state holds: a change up to ``window`` rows back needs no bars."""
    return 2 * max(params.window, params.compounding) + params.lead + 1


def _ticker() -> WindowSpec:
    return Window.partitionBy("ticker")


def _is_index(params: RiskParams) -> Column:
    return F.col("ticker").isin(params.market, params.vix)


def state_of(panel: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """The newest rows of each ticker of a panel.

    Rows that have a return and rows that take part in beta are counted apart, since
    either kind may be rare. ``whole_*`` tells that no row of the kind was ever left
    out. The market and the index keep more: they are the context of all others.
    """
    most = held_rows(params)
    if "has_market" not in panel.columns:  # the market's own rows are on its dates, but take no part in beta
        panel = panel.withColumn("has_market", F.col("has_beta_row") | (F.col("ticker") == params.market))
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    so_far = newest.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def nth_of_kind(flag: str) -> Column:  # counted in the one order of dates, so that rows are sorted once
        with_it = F.count(F.when(F.col(flag), 1)).over(so_far)
        return F.when(F.col(flag), with_it).otherwise(F.row_number().over(newest) - with_it)

    before = {c: F.col(c) if c in panel.columns else F.lit(True) for c in ("whole_returns", "whole_betas")}
    counted = panel.withColumns(
        {
            "nth": F.row_number().over(newest),
            "nth_return": nth_of_kind("has_return"),
            "nth_beta": nth_of_kind("has_beta_row"),
            "returns": F.count(F.when(F.col("has_return"), 1)).over(_ticker()),
            "betas": F.count(F.when(F.col("has_beta_row"), 1)).over(_ticker()),
            "rows": F.count("*").over(_ticker()),
            "_returns_before": F.min(before["whole_returns"]).over(_ticker()),
            "_betas_before": F.min(before["whole_betas"]).over(_ticker()),
        }
    )
    keep = F.when(_is_index(params), F.col("nth") <= 3 * most).otherwise(
        (F.col("nth_return") <= most) | (F.col("nth_beta") <= most)
    )
    all_kept = F.when(_is_index(params), F.col("rows") <= 3 * most)
    return (
        counted.filter(keep)
        .withColumn("whole_returns", F.col("_returns_before") & F.coalesce(all_kept, F.col("returns") <= most))
        .withColumn("whole_betas", F.col("_betas_before") & F.coalesce(all_kept, F.col("betas") <= most))
        .select(*[F.col(f.name).cast(f.dataType) for f in RISK_STATE])
    )


def _together(state: DataFrame, changes: DataFrame, from_date: dt.date | None) -> DataFrame:
    """Held and changed rows of each ticker, a changed one in the place of a held one of its date.

    ``floor`` is the first date of the ticker that has to be worked out anew, NULL if there is none.
    """
    side = F.col("side")
    held = state.withColumn("side", F.lit(0))
    new = changes.select("ticker", "date", "adj_close").withColumn("side", F.lit(1))
    following = F.lead("date").over(Window.partitionBy("ticker").orderBy("date", "side"))
    return (
        held.unionByName(new, allowMissingColumns=True)
        .withColumn("floor", F.least(F.min(F.when(side == 1, F.col("date"))).over(_ticker()), F.lit(from_date).cast("date")))
        .withColumn("following", following)
        .filter(F.col("following").isNull() | (F.col("following") != F.col("date")))
        .drop("following")
    )


def context_floor(changes: DataFrame, params: RiskParams = DEFAULTS) -> dt.date | None:
    """The first date on which the market or the index has changed."""
    return changes.filter(_is_index(params)).agg(F.min("date")).first()[0]


def deep_tickers(state: DataFrame, changes: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """(ticker): those for which the state does not reach back far enough before their first change."""
    indices = state.filter(_is_index(params)).groupBy("ticker").agg(F.min("date").alias("first"), F.min("whole_returns").alias("whole"))
    reach = [r["first"] for r in indices.collect() if not r["whole"]]  # two rows at most
    warm, most = max(params.window, params.compounding), held_rows(params)
    rows = _together(state, changes, context_floor(changes, params)).filter(F.col("floor").isNotNull())
    before = F.col("date") < F.col("floor")
    held_return, held_beta = F.col("daily_return").isNotNull(), F.coalesce("has_market", F.lit(False))
    count = lambda which: F.count(F.when(which, 1))
    per = rows.groupBy("ticker").agg(
        F.first("floor").alias("floor"),
        F.max(~before).alias("affected"),
        count(before & held_return).alias("returns"),
        count(before & held_beta).alias("betas"),
        count(before & F.col("beta_30d").isNotNull()).alias("known_betas"),
        count(~before & ~held_return & (F.col("side") == 0)).alias("gaps_after"),
        F.coalesce(F.min("whole_returns"), F.lit(True)).alias("whole_returns"),
        F.coalesce(F.min("whole_betas"), F.lit(True)).alias("whole_betas"),
    )
    enough_returns = F.col("whole_returns") | ((F.col("returns") >= warm) & (F.col("gaps_after") < most))
    enough_betas = F.col("whole_betas") | (F.col("ticker") == params.market) | ((F.col("betas") >= warm) & (F.col("known_betas") >= params.lead))
    in_reach = F.lit(True) if not reach else F.col("floor") > F.lit(max(reach))
    return per.filter(F.col("affected") & ~(enough_returns & enough_betas & in_reach)).select("ticker")


def advance(state: DataFrame, changes: DataFrame, params: RiskParams = DEFAULTS) -> DataFrame:
    """A step: all rows of the new state, before ``state_of`` cuts it, in the shape of a risk panel.

    ``fresh`` are the rows from a ticker's first change on, ``moved`` those and others whose target is not what it was.
    ``changes`` has one row per (ticker, date): what is now the newest bar there. Its tickers, and those that a change
    of the market or the index concerns, must not be deep.
    """
    together = _together(state, changes, context_floor(changes, params))
    fresh = F.coalesce(F.col("date") >= F.col("floor"), F.lit(False))
    previous = F.lag("adj_close").over(_ticker().orderBy("date"))
    rows = together.withColumn("fresh", fresh).withColumn(
        "daily_return",
        F.when(F.col("fresh"), safe_div(F.col("adj_close"), previous) - 1).otherwise(F.col("daily_return")),
    )
    context = broadcast_calendar(series.date_context(rows, params).select("date", *[F.col(c).alias(f"new_{c}") for c in series.CONTEXT]))
    rows = rows.join(context, "date", "left")
    rows = rows.withColumns({c: F.when(F.col("fresh"), F.col(f"new_{c}")).otherwise(F.col(c)) for c in series.CONTEXT})
    held = [F.col(c).alias(f"held_{c}") for c in (*_FIGURES, "beta_30d_drift_5d")]
    gone = (*_FIGURES, "beta_30d_drift_5d", *[f"new_{c}" for c in series.CONTEXT])
    carried = rows.select(*[c for c in rows.columns if c not in gone], *held)
    figures = series.panel_figures(series.with_flags(carried, params), params)
    figures = figures.withColumns({c: F.when(F.col("fresh"), F.col(c)).otherwise(F.col(f"held_{c}")) for c in _FIGURES})
    figures = figures.withColumn("has_beta", F.col("beta_30d").isNotNull())
    by_beta = Window.partitionBy("ticker", "has_beta").orderBy("date")
    ahead = F.lead("beta_30d", params.lead).over(by_beta)
    reaches = F.coalesce(F.lead("fresh", params.lead).over(by_beta), F.lit(True))
    target = F.when(F.col("has_beta"), ahead - F.col("beta_30d"))
    figures = figures.withColumn("target", target).withColumn("reaches", reaches)
    figures = figures.withColumn(
        "beta_30d_drift_5d",
        F.when(F.col("fresh") | (F.col("reaches") & F.col("floor").isNotNull()), F.col("target")).otherwise(F.col("held_beta_30d_drift_5d")),
    )
    other = ~F.col("beta_30d_drift_5d").eqNullSafe(F.col("held_beta_30d_drift_5d"))
    return figures.withColumn("moved", F.col("fresh") | other)


def known_betas(state: DataFrame, params: RiskParams = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(date, ticker, beta_30d) of the newest rows that take part in beta, without gaps; and (ticker, first) of each
    ticker the date from which on these are all there are, NULL if from the beginning."""
    most = held_rows(params)
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    rows = (
        state.filter(F.col("has_market") & (F.col("ticker") != params.market))
        .withColumn("nth", F.row_number().over(newest))
        .filter(F.col("nth") <= most)
    )
    first = F.when(F.min("whole_betas"), F.lit(None).cast("date")).otherwise(F.min("date"))
    return rows.select("date", "ticker", "beta_30d"), rows.groupBy("ticker").agg(first.alias("first"))


def out_of_reach(
    dates: DataFrame, reach: DataFrame, params: RiskParams = DEFAULTS, mode: str = "forward"
) -> DataFrame:
    """(ticker): those with one of the ``dates`` before what the state knows whole, or that it knows nothing of.

    ``as_coded`` looks back from a date, so the rows before it have to be known too: it always asks for the bars
    unless the state is whole.
    """
    before = F.col("first").isNotNull() & ((F.col("date") < F.col("first")) | F.lit(mode != "forward"))
    known = reach.withColumn("known", F.lit(True))
    return dates.join(known, "ticker", "left").filter(F.col("known").isNull() | before).select("ticker").distinct()

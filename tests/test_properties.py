"""Statements that hold for any input."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.operators import comoments, features, portfolio, prices, series, value_at_risk
from marketlens.operators.correlation import correlation_matrix
from marketlens.params import RiskParams
from marketlens.sources.lineitem_bars import bars_from_lineitem


def _random_clean(spark, tickers, days, seed=3, missing=0.1, empty=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for t in tickers:
        price = 100.0
        for d in range(days):
            price *= float(np.exp(rng.normal(0, 0.03)))
            if rng.random() < missing:
                continue
            shown = None if rng.random() < empty else price
            rows.append((dt.date(2023, 1, 1) + dt.timedelta(days=d), t, shown, int(rng.integers(1, 99))))
    return spark.createDataFrame(rows, "date date, ticker string, adj_close double, volume long")


@pytest.fixture(scope="module")
def clean(spark):
    tickers = ["^GSPC", "^VIX", *[f"S{i:02d}" for i in range(12)]]
    return _random_clean(spark, tickers, 150).cache()


def _as_dict(df, value):
    return {(r.ticker, r.date): r[value] for r in df.collect()}


@pytest.mark.parametrize("params", [RiskParams(), RiskParams(window=7, lead=3, compounding=4, min_periods=5)])
def test_panel_equals_the_single_operators(spark, clean, params):
    """The one-pass panel and the filter-first operators agree, gaps and NULLs included."""
    returns = series.daily_returns(clean)
    panel = series.risk_panel(returns, params).cache()
    beta = series.rolling_beta(returns, params)
    cases = [
        (series.rolling_volatility(returns, params), "annualized_volatility_30d", "has_return"),
        (series.cumulative_return(returns, params), "cumulative_return_5d", "has_return"),
        (beta, "beta_30d", "has_beta_row"),
        (series.beta_drift(beta, params), "beta_30d_drift_5d", "beta_30d is not null"),
    ]
    for alone, value, where in cases:
        want = _as_dict(alone, value)
        got = _as_dict(panel.filter(where), value)
        assert got.keys() == want.keys()
        for key, w in want.items():
            assert got[key] == (None if w is None else pytest.approx(w, abs=1e-9)), (value, key)


def test_features_equal_the_joined_views(spark, clean):
    returns = series.daily_returns(clean)
    drift = series.beta_drift(series.rolling_beta(returns))
    joined = (
        drift.join(series.rolling_volatility(returns), ["ticker", "date"])
        .join(series.cumulative_return(returns).drop("daily_return"), ["ticker", "date"])
        .join(series.vix_regime(clean).drop("adj_close"), "date")
    )
    got = features.risk_features(series.risk_panel(returns))
    assert got.count() == joined.count() > 0
    assert got.join(joined, ["ticker", "date"], "left_anti").count() == 0


def test_drawdown_is_never_positive(clean):
    assert series.max_drawdown(clean).filter("max_drawdown_pct > 0").count() == 0


@pytest.mark.parametrize("per_block,stretch", [(256, 512), (3, 40), (2, 7)])
def test_correlation_equals_pandas_whatever_the_blocks(clean, per_block, stretch):
    returns = series.daily_returns(clean)
    flat = returns.toPandas().dropna(subset=["daily_return"])
    names = sorted(flat["ticker"].unique())[:14]
    got = correlation_matrix(returns, names, per_block, stretch).toPandas()
    assert len(got) == len(names) * (len(names) + 1) // 2
    want = flat[flat["ticker"].isin(names)].pivot(index="date", columns="ticker", values="daily_return").corr()
    wide = got.pivot(index="ticker_x", columns="ticker_y", values="correlation")
    wide = wide.combine_first(wide.T)
    pd.testing.assert_frame_equal(wide, want, check_names=False, check_exact=False, atol=1e-9)


def test_correlation_wants_a_list(clean):
    with pytest.raises(ValueError):
        correlation_matrix(series.daily_returns(clean), [])


def test_correlation_of_a_frame_of_names(spark, clean):
    """Names stay in their frame, and pairs come from one task each: no join brings them together."""
    returns = series.daily_returns(clean)
    names = [r["ticker"] for r in returns.select("ticker").distinct().orderBy("ticker").limit(9).collect()] + ["NONE"]
    frame = spark.createDataFrame([(n,) for n in [*names, names[0], None]], "ticker string")
    key = ["ticker_x", "ticker_y"]
    got = correlation_matrix(returns, frame, 3)
    assert "Project [ticker_x" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = got.orderBy(*key).collect()
    want = correlation_matrix(returns, names).orderBy(*key).collect()
    assert [(r["ticker_x"], r["ticker_y"], r["days"]) for r in rows] == [(r["ticker_x"], r["ticker_y"], r["days"]) for r in want]
    assert len(rows) == 55 and sum(r["days"] == 0 for r in rows) >= 10
    for r, w in zip(rows, want, strict=True):
        assert r["correlation"] == (None if w["correlation"] is None else pytest.approx(w["correlation"], abs=1e-9))


@pytest.mark.parametrize("per_block", [4096, 4])
def test_correlation_of_parts_equals_merged_moments(clean, per_block):
    """The same as moments by period that are merged, and nothing of the size of the pairs is shuffled."""
    returns = series.daily_returns(clean)
    late = F.col("date") >= F.lit("2023-02-20").cast("date")
    key = ["ticker_x", "ticker_y"]
    got = comoments.correlations_of_parts(returns, late.cast("int"), per_block)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1
    parts = comoments.moments(returns.filter(late)).unionByName(comoments.moments(returns.filter(~late)))
    want = comoments.correlations(parts).orderBy(*key).collect()
    rows = got.orderBy(*key).collect()
    assert [(r["ticker_x"], r["ticker_y"], r["days"]) for r in rows] == [(r["ticker_x"], r["ticker_y"], r["days"]) for r in want]
    for r, w in zip(rows, want, strict=True):
        assert r["correlation"] == (None if w["correlation"] is None else pytest.approx(w["correlation"], abs=1e-9))


def test_archive_and_retained_split_the_bars(spark, sf_dir):
    bars = bars_from_lineitem(spark, sf_dir)
    today = bars.agg(F.max("date")).first()[0]
    gone, kept = prices.rows_to_archive(bars, today), prices.rows_to_retain(bars, today)
    assert gone.count() + kept.count() == bars.count()
    assert gone.join(kept, ["id", "ticker", "date"], "left_semi").count() == 0


def test_dedup_with_a_hot_key(spark):
    """A third of all bars share one key; the answer is that of a brute-force pass."""
    rows = spark.range(60_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("ticker"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date").alias("date"),
        (F.xxhash64("id") % 1000).cast("double").alias("adj_close"),
        F.col("id").alias("volume"),
    )
    want = rows.toPandas().sort_values("id").groupby(["date", "ticker"]).tail(1)
    got = prices.dedup_bars(rows).toPandas()
    assert set(got.itertuples(index=False, name=None)) == set(want[got.columns].itertuples(index=False, name=None))


def test_numbering_is_dense_and_ignores_the_layout(spark):
    keys = spark.range(1000).select(F.concat(F.lit("t"), "id").alias("ticker"))
    one = features.number_rows(keys, "n", ["ticker"], 500, buckets=16)
    two = features.number_rows(keys.repartition(13), "n", ["ticker"], 500, buckets=16)
    assert sorted(r.n for r in one.collect()) == list(range(501, 1501))
    assert sorted(one.collect()) == sorted(two.collect())


def test_drawdowns_of_parts_add_up(spark):
    """However a ticker's history is cut, its parts give what the window gives; and a day is merged with what there is."""
    import datetime as dt
    import random

    draw = random.Random(3)
    rows = [
        (dt.date(2019, 1, 1) + dt.timedelta(days=7 * i), t, None if draw.random() < 0.05 else round(draw.uniform(1, 100), 2), 1)
        for t in "ABC"
        for i in range(200)
    ]
    clean = spark.createDataFrame(rows, "date date, ticker string, adj_close double, volume long")
    want = sorted(map(tuple, series.max_drawdown(clean).collect()))
    parts = series.drawdown_parts(clean)
    assert parts.groupBy("ticker").count().filter("count < 3").count() == 0
    close = lambda rows: [(t, pytest.approx(f), h, l) for t, f, h, l in rows]  # noqa: E731, E741
    assert sorted(map(tuple, series.drawdown_of(series.merge_drawdowns(parts)).collect())) == close(want)
    before, day = clean.filter("date < '2022-10-20'"), clean.filter("date >= '2022-10-20'")
    held = series.merge_drawdowns(series.drawdown_parts(before))
    again = series.merge_drawdowns(held.unionByName(series.drawdown_parts(day)))
    assert sorted(map(tuple, series.drawdown_of(again).collect())) == close(want)


def test_portfolios_from_a_table(spark, monkeypatch):
    import datetime as dt

    from marketlens.operators import portfolio

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    moves = [(d, t, ((i * 7 + ord(t[0])) % 11 - 5) / 100 if (i + ord(t[0])) % 6 else None) for i, d in enumerate(days) for t in ("A", "B", "C", "H")]
    returns = spark.createDataFrame(moves, "date date, ticker string, daily_return double")
    named = {f"p{i}": {"H": 0.5, "ABC"[i % 3]: 0.5} for i in range(40)}
    table = [(p, t, w) for p, held in named.items() for t, w in held.items()]
    odd = [("q", "H", 0.25), ("q", "H", 0.25), ("q", "A", 0.5), (None, "A", 1.0), ("r", None, 1.0), ("r", "A", None)]
    weights = spark.createDataFrame(table + odd, "portfolio string, ticker string, weight double")
    want = sorted(map(tuple, portfolio.portfolio_stress(returns, named | {"q": {"H": 0.5, "A": 0.5}}).collect()))
    monkeypatch.setattr(portfolio, "HOLDERS_TOGETHER", 3)  # H is dealt out
    got = sorted(map(tuple, portfolio.portfolio_stress_of(returns, weights).collect()))
    assert len(want) == 41
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], abs=1e-12) and g[3] == w[3]


def test_portfolios_that_hold_the_same_are_worked_out_once(spark, clean):
    """All hold what is worked out for one of them; days come from the member with the fewest, dealt to tasks by number."""
    returns = series.daily_returns(clean)
    a, b = [r["ticker"] for r in returns.select("ticker").distinct().orderBy("ticker").limit(2).collect()]
    short = returns.filter((F.col("ticker") != b) | (F.dayofmonth("date") < 20))
    rows = [(f"p{i}", t, w) for i in range(40) for t, w in ((a, 0.25), (b, 0.75))] + [("q", a, 0.5), ("q", "NONE", 0.5), ("r", a, 1.0)]
    weights = spark.createDataFrame(rows, "portfolio string, ticker string, weight double")
    got = portfolio.portfolio_stress_of(short, weights)
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    found = {r["portfolio"]: tuple(r)[1:] for r in got.collect()}
    assert set(found) == {"r", *(f"p{i}" for i in range(40))}
    want = portfolio.portfolio_stress(short, {"p": {a: 0.25, b: 0.75}, "r": {a: 1.0}}).collect()
    want = {r["portfolio"]: tuple(r)[1:] for r in want}
    assert found["r"] == pytest.approx(want["r"]) and all(found[f"p{i}"][0] == want["p"][0] and found[f"p{i}"][2] == want["p"][2] for i in range(40))
    assert len({v[1] for k, v in found.items() if k != "r"}) == 1 and found["p0"][1] == pytest.approx(want["p"][1])


def test_only_rows_that_are_chosen_are_simulated(clean):
    """Rows of several runs share a ticker's draws, and what is chosen before has the figures it would have had."""
    runs = [(value_at_risk.recent_returns(clean, p), F.lit(f"2024-01-0{i} 00:00:00"), p) for i, p in enumerate((RiskParams(), RiskParams(lookback=40)), 1)]
    whole = [value_at_risk.var_summary(*run) for run in runs]
    want = sorted(map(tuple, value_at_risk.latest_var(whole[0].unionByName(whole[1])).collect()))
    figures = [value_at_risk.var_figures(*run) for run in runs]
    both = figures[0].unionByName(figures[1])
    chosen = value_at_risk.with_simulation(value_at_risk.latest_var(both))
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RankLimit" if "RankLimit" in plan else "row_number")
    assert sorted(map(tuple, chosen.collect())) == want
    together = sorted(map(tuple, value_at_risk.with_simulation(both).collect()))
    assert together == sorted(t for w in whole for t in map(tuple, w.collect()))


def test_blocks_of_tickers_follow_from_their_returns():
    """Tickers with few returns need fewer blocks, so fewer copies are shuffled; a block's returns stay within the bound."""
    from marketlens.operators import correlation as c

    dense, sparse = c.blocks_holding(180_000, 180_000 * 2_560), c.blocks_holding(180_000, 180_000 * 560)
    assert dense == c.blocks_for(180_000) == 44 and sparse == 11
    for tickers, returns in ((180_000, 10**8), (5_000, 10**9), (40_000, 10**7), (10**6, 10**6)):
        blocks = c.blocks_holding(tickers, returns)
        assert returns / blocks <= c.RETURNS_PER_GROUP and tickers / blocks <= c.MOST_TICKERS_PER_GROUP
    assert c.blocks_holding(1, 0) == 1


def test_a_frame_of_returns_is_dealt_by_its_rows(clean, monkeypatch):
    from marketlens.operators import correlation as c

    returns = series.daily_returns(clean)
    names = sorted(r["ticker"] for r in returns.select("ticker").distinct().collect())
    asked = []
    monkeypatch.setattr(c, "correlated_pairs", lambda *given, real=c.correlated_pairs: asked.append(given[2]) or real(*given))
    want = c.correlation_matrix(returns, names, 256).orderBy("ticker_x", "ticker_y").collect()
    monkeypatch.setattr(c, "RETURNS_PER_GROUP", -(-returns.count() // 3))
    got = c.correlation_matrix(returns, names).orderBy("ticker_x", "ticker_y").collect()
    assert asked[-1] == 3
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == [None if r[3] is None else pytest.approx(r[3], abs=1e-9) for r in want]

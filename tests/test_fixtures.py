"""Small inputs with answers worked out by hand."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.functions import (
    register_safe_math,
    safe_div,
    safe_exp,
    safe_ln,
    safe_pow,
    safe_sqrt,
)
from marketlens.operators import features, portfolio, prices, reports, series
from marketlens.operators import value_at_risk as var
from marketlens.operators.correlation import correlation_matrix
from marketlens.params import RiskParams

DAY0 = dt.date(2024, 1, 1)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def clean_frame(spark, **prices_by_ticker):
    rows = [
        (day(i), ticker.replace("IDX_", "^"), p, 100 + i)
        for ticker, ps in prices_by_ticker.items()
        for i, p in enumerate(ps)
    ]
    return spark.createDataFrame(rows, "date date, ticker string, adj_close double, volume long")


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


def close(got, want, places=9):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None) == (w is None), (got, want)
        if w is not None:
            assert g == pytest.approx(w, abs=10**-places)


def test_f1_returns(spark):
    df = series.daily_returns(clean_frame(spark, A=[100.0, 110.0, 99.0]))
    close(column(df, "daily_return"), [None, 0.1, -0.1])


def test_f2_volatility_warms_up_with_fixed_divisors(spark):
    r = series.daily_returns(clean_frame(spark, A=[100.0, 110.0, 99.0]))
    close(
        column(series.rolling_volatility(r), "annualized_volatility_30d"),
        [0.2898275349, 0.4168850003],
    )
    waiting = series.rolling_volatility(r, RiskParams(min_periods=2))
    close(column(waiting, "annualized_volatility_30d"), [None, 0.4168850003])


def _two_times_market(spark, n=80):
    moves = [0.01 * math.sin(i * 1.7) + 0.002 for i in range(n)]
    market, stock = [100.0], [50.0]
    for m in moves:
        market.append(market[-1] * (1 + m))
        stock.append(stock[-1] * (1 + 2 * m))
    return clean_frame(spark, IDX_GSPC=market, A=stock)


def test_f3_beta_of_twice_the_market_is_two(spark):
    beta = series.rolling_beta(series.daily_returns(_two_times_market(spark)))
    got = column(beta, "beta_30d")
    assert got[0] is None
    close(got[1:], [2.0] * 80)
    assert {r["ticker"] for r in beta.select("ticker").collect()} == {"A"}


def test_f4_beta_against_a_flat_market_is_null(spark):
    clean = clean_frame(spark, IDX_GSPC=[10.0] * 5, A=[1.0, 2.0, 3.0, 2.0, 1.0])
    assert column(series.rolling_beta(series.daily_returns(clean)), "beta_30d") == [None] * 5


def test_beta_keeps_a_slot_for_rows_without_a_stock_return(spark):
    # the stock's first return is missing while the market has one that day
    rows = [(day(i), "^GSPC", p, 1) for i, p in enumerate([100.0, 110.0, 99.0, 108.9])]
    rows += [(day(i), "A", p, 1) for i, p in enumerate([50.0, 60.0, 54.0], start=1)]
    clean = spark.createDataFrame(rows, "date date, ticker string, adj_close double, volume long")
    m = [0.1, -0.1, 0.1]
    s = [None, 0.2, -0.1]

    def beta(window):
        lines = []
        for end in range(3):
            span = range(max(0, end - window + 1), end + 1)
            sm = sum(m[i] for i in span)
            smm = sum(m[i] ** 2 for i in span)
            seen = [i for i in span if s[i] is not None]
            if not seen:
                lines.append(None)
                continue
            ss = sum(s[i] for i in seen)
            ssm = sum(s[i] * m[i] for i in seen)
            lines.append((ssm - ss * sm / window) / (smm - sm * sm / window))
        return lines

    for window in (2, 30):
        params = RiskParams(window=window)
        r = series.daily_returns(clean)
        alone = series.rolling_beta(r, params).filter("ticker = 'A'")
        close(column(alone, "beta_30d"), beta(window))
        panel = series.risk_panel(r, params).filter("ticker = 'A'")
        close(column(panel, "beta_30d"), beta(window))


def test_f5_drawdown(spark):
    row = series.max_drawdown(clean_frame(spark, A=[100.0, 120.0, 90.0, 130.0])).first()
    assert (row.max_drawdown_pct, row.cycle_high, row.cycle_low) == (-25.0, 130.0, 90.0)


def test_f6_zero_price(spark):
    r = series.daily_returns(clean_frame(spark, A=[10.0, 0.0, 5.0]))
    close(column(r, "daily_return"), [None, -1.0, None])
    close(column(series.cumulative_return(r), "cumulative_return_5d"), [0.0])


def test_f7_missing_price_in_mid_series(spark):
    r = series.daily_returns(clean_frame(spark, A=[100.0, None, 120.0, 132.0]))
    close(column(r, "daily_return"), [None, None, None, 0.1])


def test_f8_cumulative_return(spark):
    r = series.daily_returns(clean_frame(spark, A=[100.0, 110.0, 121.0, 133.1]))
    close(column(series.cumulative_return(r), "cumulative_return_5d"), [0.1, 0.21, 0.331])


def test_f9_regimes(spark):
    clean = clean_frame(spark, IDX_VIX=[14.99, 15.0, 25.0, 25.01, None])
    assert column(series.vix_regime(clean), "market_regime_vix") == [0, 1, 1, 2]


def _bars(spark, rows):
    full = [
        (i, t, d, p, p + 1, p - 1, p, p, v, dt.datetime(2024, 1, 1)) for i, t, d, p, v in rows
    ]
    return spark.createDataFrame(full, schemas.BRONZE_BARS)


def test_f10_dedup_keeps_the_highest_id(spark):
    bars = _bars(spark, [(1, "A", day(0), 1.0, 1), (5, "A", day(0), 5.0, 5), (3, "A", day(0), 3.0, 3)])
    once = prices.dedup_bars(bars)
    assert [(r.id, r.close, r.volume) for r in once.collect()] == [(5, 5.0, 5)]
    assert prices.dedup_bars(once).collect() == once.collect()
    row = prices.clean_prices(bars).first()
    assert (row.adj_close, row.volume) == (5.0, 5)


def test_dedup_takes_a_missing_price_of_the_newest_bar(spark):
    bars = _bars(spark, [(1, "A", day(0), 1.0, 1)]).unionByName(
        spark.createDataFrame(
            [(2, "A", day(0), None, None, None, None, None, None, None)], schemas.BRONZE_BARS
        )
    )
    row = prices.dedup_bars(bars).first()
    assert (row.id, row.adj_close, row.volume) == (2, None, None)


def test_f11_drift(spark):
    betas = [1.0, 1.5, 2.5, 4.0, 6.0, 8.5, 11.5]
    df = spark.createDataFrame(
        [(day(i), "A", b) for i, b in enumerate(betas)], "date date, ticker string, beta_30d double"
    )
    close(column(series.beta_drift(df), "beta_30d_drift_5d"), [7.5, 10.0] + [None] * 5)


def _features(spark, dates, ticker="A"):
    return spark.createDataFrame(
        [(ticker, d, 0.1, 1.0 + i, 0.01, 1.0, None) for i, d in enumerate(dates)],
        schemas.RISK_FEATURES,
    )


def test_f12_matured_metrics(spark):
    six = features.matured_metrics(_features(spark, [day(i) for i in range(6)]))
    assert [r.date for r in six.collect()] == [day(0)]
    assert features.matured_metrics(_features(spark, [day(i) for i in range(5)])).count() == 0
    feats = _features(spark, [day(i) for i in range(8)])
    first = features.matured_metrics(feats).filter(F.col("date") == day(0))
    assert column(features.matured_metrics(feats, first), "date") == [day(1), day(2)]


def test_f13_upsert(spark):
    old = _features(spark, [day(0), day(1)])
    new = _features(spark, [day(1), day(2)]).withColumn("feat_rolling_vol_30d", F.lit(9.0))
    once = features.upsert(old, new)
    assert column(once, "feat_rolling_vol_30d") == [0.1, 9.0, 9.0]
    twice = features.upsert(once, new)
    assert sorted(twice.collect()) == sorted(once.collect())


def test_f14_backfill(spark):
    beta = spark.createDataFrame(
        [(day(i), "A", float(i)) for i in range(1, 12)],
        "date date, ticker string, beta_30d double",
    )
    rows = [
        (1, None, "A", day(6), 1.0, 0.5, 1.5, "v", None, None),
        (2, None, "A", day(6), 1.0, 0.5, 1.5, "v", 3.0, None),
        (3, None, "B", day(6), 1.0, 0.5, 1.5, "v", None, None),
    ]
    predictions = spark.createDataFrame(rows, schemas.RISK_INFERENCE)
    for mode, realised in (("forward", 11.0), ("as_coded", 1.0)):
        got = features.backfill_actuals(predictions, beta, mode)
        assert column(got, "actual_beta_realized", "prediction_id") == [realised, 3.0, None]
        assert column(got, "prediction_error", "prediction_id") == [realised - 1.5, 1.5, None]


def test_f15_latest_var(spark):
    at = dt.datetime
    rows = [
        ("X", at(2024, 1, 1, 9), 1.0, 1.0, 1.0, "x"),
        ("Y", at(2024, 1, 1, 9), 2.0, 2.0, 2.0, "y"),
        ("Y", at(2024, 1, 2, 9), 3.0, 3.0, 3.0, "y"),
        ("Y", at(2024, 1, 2, 17), 4.0, 4.0, 4.0, "y"),
    ]
    got = var.latest_var(spark.createDataFrame(rows, schemas.VAR_SUMMARY)).collect()
    assert [(r.ticker, r.historical_var) for r in got] == [("Y", 4.0)]


def test_latest_prediction_is_of_the_latest_date(spark):
    rows = [
        (1, None, "X", day(1), 1.0, 0.0, 1.0, "v", None, None),
        (2, None, "Y", day(2), 1.0, 0.0, 1.0, "v", None, None),
        (3, None, "Y", day(2), 2.0, 0.0, 2.0, "v", None, None),
        (4, None, "Y", day(1), 3.0, 0.0, 3.0, "v", None, None),
    ]
    got = features.latest_predictions(spark.createDataFrame(rows, schemas.RISK_INFERENCE)).collect()
    assert [(r.ticker, r.prediction_id) for r in got] == [("Y", 3)]


def _returns(spark, **by_ticker):
    return spark.createDataFrame(
        [(t, day(i), float(x)) for t, xs in by_ticker.items() for i, x in enumerate(xs)],
        "ticker string, date date, daily_return double",
    )


def test_f16_var(spark):
    r = _returns(spark, A=[1, 2, 4, 10])
    assert var.historical_var(r).first().historical_var == pytest.approx(1.15)
    z = -1.6448536269514722
    assert var.parametric_var(r).first().parametric_var == pytest.approx(4.25 + z * 3.4910600109)
    flipped = RiskParams(loss_magnitude=True)
    assert var.historical_var(r, flipped).first().historical_var == pytest.approx(-1.15)


def test_monte_carlo_nears_the_normal_law_and_ignores_the_layout(spark):
    r = _returns(spark, A=[1, 2, 4, 10], B=[3, 3, 3, 3])
    one = {x.ticker: x.monte_carlo_var for x in var.monte_carlo_var(r).collect()}
    many = {x.ticker: x.monte_carlo_var for x in var.monte_carlo_var(r.repartition(7)).collect()}
    assert one == many
    assert one["B"] == pytest.approx(3.0)
    assert one["A"] == pytest.approx(4.25 - 1.6449 * 3.491, abs=0.15)
    other = var.monte_carlo_var(r, RiskParams(seed=7)).filter("ticker = 'A'").first()
    assert other.monte_carlo_var != one["A"]
    single = var.monte_carlo_var(r, RiskParams(draws=1)).count()
    assert single == 2


def test_var_text_follows_the_confidence(spark):
    r = _returns(spark, A=[-0.10, 0.0, 0.01, 0.02])
    at = F.lit(dt.datetime(2024, 1, 5))
    text = var.var_summary(r, at, RiskParams(draws=100)).first().display_text
    assert text == "95% Daily VaR: 8.50% (Historical)"
    text = var.var_summary(r, at, RiskParams(draws=100, confidence=0.975)).first().display_text
    assert text.startswith("97.5% Daily VaR: ")


def test_recent_returns_cut_rows_before_dropping_missing_ones(spark):
    clean = clean_frame(spark, A=[100.0, 110.0, 121.0, None, 10.0, 11.0])
    got = var.recent_returns(clean, RiskParams(lookback=4))
    close(column(got, "daily_return"), [0.1, 0.1])
    whole = var.recent_returns(clean, RiskParams(lookback=100))
    close(column(whole, "daily_return"), [0.1, 0.1, 0.1])


def test_f17_matrix_point_on_both_medians(spark):
    mc = {"A": 1.0, "B": 2.0, "C": 3.0, "Z": 99.0}
    beta = {"A": 3.0, "B": 2.0, "C": 1.0, "Z": 99.0}
    v = spark.createDataFrame(
        [(t, dt.datetime(2024, 1, 1), 0.0, 0.0, x, "") for t, x in mc.items()], schemas.VAR_SUMMARY
    )
    p = spark.createDataFrame(
        [(i, None, t, day(0), 0.0, 0.0, x, "v", None, None) for i, (t, x) in enumerate(beta.items())],
        schemas.RISK_INFERENCE,
    )
    got = {r.ticker: r.risk_category for r in reports.risk_matrix(v, p, ["A", "B", "C"]).collect()}
    assert got == {
        "A": "High Beta / Low VaR (Efficient)",
        "B": "Low Beta / Low VaR (Defensive)",
        "C": "Low Beta / High VaR (Outlier Risk)",
    }


def test_f18_panic_periods(spark):
    got = reports.panic_periods(clean_frame(spark, IDX_VIX=[19.0, 20.0, 21.0, 19.9, 30.0]))
    rows = got.orderBy("period_start").collect()
    assert [(r.period_start, r.period_end, r.days) for r in rows] == [
        (day(1), day(2), 2),
        (day(4), day(4), 1),
    ]


def test_f19_correlation_guards(spark):
    r = _returns(spark, A=[0.1, 0.2, 0.4], B=[0.1, 0.1, 0.1], C=[-0.1, -0.2, -0.4])
    lone = spark.createDataFrame([("D", day(2), 0.3), ("D", day(9), 0.1)], r.schema)
    got = {
        (x.ticker_x, x.ticker_y): x.correlation
        for x in correlation_matrix(r.unionByName(lone), ["D", "C", "B", "A", "E"]).collect()
    }
    assert len(got) == 15 and all(x <= y for x, y in got)
    assert got["A", "A"] == pytest.approx(1.0)
    assert got["A", "C"] == pytest.approx(-1.0) and got["E", "E"] is None
    assert got["A", "B"] is None and got["B", "B"] is None and got["A", "D"] is None


def test_f20_archive(spark):
    as_of = dt.date(2024, 6, 1)
    ages = [1096, 1095, 1]
    bars = _bars(
        spark, [(i, "A", as_of - dt.timedelta(days=a), 1.0, 1) for i, a in enumerate(ages)]
    )
    gone, kept = prices.rows_to_archive(bars, as_of), prices.rows_to_retain(bars, as_of)
    assert [r.id for r in gone.collect()] == [0]
    assert column(kept, "id", "id") == [1, 2]


def test_dedupe_archive(spark):
    bars = _bars(spark, [(1, "A", day(0), 1.0, 1), (1, "A", day(0), 1.0, 1), (2, "A", day(0), 2.0, 2)])
    assert [r.id for r in prices.dedupe_archive(bars).collect()] == [2]


def test_f21_safe_math(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (4.0,)], "x double")
    x = F.col("x")
    got = df.select(
        safe_sqrt(x).alias("s"),
        safe_ln(x).alias("l"),
        safe_pow(x, 2).alias("p"),
        safe_exp(x).alias("e"),
        safe_div(F.lit(1.0), x).alias("d"),
    ).collect()
    assert [r.s for r in got] == [0, 0, 0, 2]
    close([r.l for r in got], [0, 0, 0, 1.3862943611])
    assert [r.p for r in got] == [0, 1, 0, 16]
    close([r.e for r in got], [0, math.exp(-1), 1, math.exp(4)])
    assert [r.d for r in got] == [None, -1, None, 0.25]

    register_safe_math(spark)
    df.createOrReplaceTempView("safe_input")
    from_sql = spark.sql(
        "SELECT safe_sqrt(x) s, safe_ln(x) l, safe_pow(x, 2) p, safe_exp(x) e, safe_div(1, x) d"
        " FROM safe_input"
    ).collect()
    assert from_sql == got


def test_moving_average_waits_for_a_full_span(spark):
    clean = clean_frame(spark, A=[1.0, 2.0, 3.0, 4.0])
    close(column(series.moving_averages(clean, (2, 3)), "sma_2"), [None, 1.5, 2.5, 3.5])
    close(column(series.moving_averages(clean, (2, 3)), "sma_3"), [None, None, 2.0, 3.0])


def test_rolling_volume_skips_missing(spark):
    clean = clean_frame(spark, A=[1.0, 2.0, 3.0]).withColumn(
        "volume", F.when(F.col("date") != F.lit(day(1)), F.col("volume"))
    )
    close(column(series.rolling_volume(clean), "rolling_volume_30d"), [100.0, 101.0])


def test_portfolio_needs_all_members(spark):
    r = _returns(spark, A=[0.1] * 6, B=[-0.2] * 5)
    got = portfolio.portfolio_stress(r, {"ab": {"A": 0.5, "B": 0.5}, "a": {"A": 1.0}}).collect()
    rows = {x.portfolio: x for x in got}
    assert rows["ab"].windows == 1 and rows["a"].windows == 2
    assert rows["ab"].worst_return_5d == pytest.approx(0.95**5 - 1)
    assert rows["ab"].worst_date == day(4)


def test_quality_gate(spark):
    rows = _features(spark, [day(0), day(1)]).withColumn(
        "predicted_drift", F.when(F.col("date") == F.lit(day(0)), F.lit(0.1))
    )
    rows = rows.withColumn("feat_rolling_beta_130d", F.lit(4.5))
    got = reports.quality_gate(rows, day(3)).first()
    assert (got.rows, got.null_predictions, got.extreme_betas, got.stale, got.passed) == (
        2, 1, 2, False, False,
    )
    fine = rows.withColumn("predicted_drift", F.lit(0.1))
    assert reports.quality_gate(fine, day(3)).first().passed
    assert reports.quality_gate(fine, day(4)).first().stale
    # two days later at six in the evening it is older than 48 hours
    evening = dt.datetime.combine(day(3), dt.time(18))
    assert reports.quality_gate(fine, evening).first().stale
    assert not reports.quality_gate(fine, evening).first().passed
    assert reports.quality_gate(fine, evening - dt.timedelta(hours=18)).first().passed


def test_regime_label(spark):
    df = spark.range(4).select(reports.regime_label(F.col("id")).alias("label"))
    assert [r.label for r in df.collect()] == [
        "Quiet (Low Volatility)",
        "Standard (Moderate Risk)",
        "Stress (High Risk/Panic)",
        "Stress (High Risk/Panic)",
    ]

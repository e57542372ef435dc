"""What the physical plans must and must not contain."""

import datetime as dt
import re

import pytest

from marketlens import schemas
from marketlens.operators import prices, series, value_at_risk as var
from marketlens.operators import features
from marketlens.sources import landing, tables
from marketlens.sources.lineitem_bars import bars_from_lineitem


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark, sf_dir):
    return prices.clean_prices(bars_from_lineitem(spark, sf_dir))


def test_dedup_reduces_before_the_shuffle(clean):
    text = plan(clean)
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert "partial_max_by" in text and "Window" not in text


def test_dedup_reads_only_what_it_needs(clean):
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan(clean.select("date", "ticker", "volume"))).group(1)
    assert "l_tax" not in schema and "l_quantity" not in schema


def test_one_ticker_exchange_for_the_whole_panel(clean):
    """Lag, volatility, compounding, beta and drift share the shuffle of the returns."""
    text = plan(features.risk_features(series.risk_panel(series.daily_returns(clean))))
    main = text[: text.index("BroadcastExchange")]
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", main)) == 1
    assert "SortMergeJoin" not in text


def test_beta_shares_the_returns_shuffle_and_sort(clean):
    text = plan(series.beta_drift(series.rolling_beta(series.daily_returns(clean))))
    main = text[: text.index("BroadcastExchange")]
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", main)) == 1
    assert main.count("Sort [") == 1


def test_recent_returns_cut_history_before_the_shuffle(clean):
    text = plan(var.recent_returns(clean))
    shuffle = text.index("Exchange hashpartitioning(ticker")
    assert "WindowGroupLimit" in text[shuffle:] and "Partial" in text[shuffle:]


def test_upsert_reads_each_side_once(spark, sf_dir):
    from marketlens.plans import queries as q

    text = plan(q.registry()["silver_risk_features_merge"](spark, sf_dir))
    # bars and the market's bars, for either side; the newest date is read from another column alone
    assert len(re.findall(r"ReadSchema: struct<[^>]*l_suppkey", text)) == 4


def test_back_fill_computes_beta_once(spark, sf_dir):
    from marketlens.plans import queries as q

    text = plan(q.registry()["inference_backfill_forward"](spark, sf_dir))
    # the bars and the market's, for the panel and, of the panel again, for the betas
    assert len(re.findall(r"ReadSchema: struct<[^>]*l_suppkey", text)) <= 4


def test_risk_matrix_has_no_constant_key(spark, sf_dir):
    from marketlens.plans import queries as q

    text = plan(q.registry()["risk_matrix"](spark, sf_dir))
    assert "hashpartitioning(0," not in text and "windowspecdefinition(0," not in text


def test_date_range_reaches_the_scan(spark, sf_dir):
    bars = landing.scan_bars(bars_from_lineitem(spark, sf_dir), None, "1997-01-01", "1998-01-01")
    bars.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 2000)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan(bars)).group(1)
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed


def test_market_series_reach_the_scan_of_stored_bars(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    row = (1, "A", day, 1.0, 1.0, 1.0, 1.0, 1.0, 1, dt.datetime(2024, 1, 2))
    tables.append(spark.createDataFrame([row], schemas.BRONZE_BARS), str(tmp_path), "bronze_price_history")
    bars = tables.read(spark, str(tmp_path), "bronze_price_history")
    returns = series.daily_returns(prices.clean_prices(bars))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    assert "EqualTo(ticker,^GSPC)" in plan(series.market_returns(returns))
    context = plan(series.date_context(returns))
    assert "Or(EqualTo(ticker,^GSPC),EqualTo(ticker,^VIX))" in context
    read = re.search(r"ReadSchema: struct<([^>]*)", context).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"id", "ticker", "date", "adj_close"}


def test_simulated_draws_are_spread_and_not_shuffled(clean):
    text = plan(var.monte_carlo_var(var.recent_returns(clean)))
    spelled_out = text.index("Generate explode")
    assert "Exchange" not in text[:spelled_out]
    spread = re.search(r"Exchange hashpartitioning\(ticker#\d+, \d+\), (\w+)", text[spelled_out:])
    assert spread.group(1) == "REPARTITION_BY_NUM"

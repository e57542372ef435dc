"""Features from carried state against a rebuild from all bars."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.operators import carried, features, prices, series
from marketlens.params import RiskParams

SMALL = RiskParams(window=6, lead=2, compounding=3)
DAY0 = dt.date(2024, 1, 1)
BARS = "id long, ticker string, date date, adj_close double, volume long"


def simulated(seed, days):
    """Batches of bars day by day: gaps, days without the market or the index, nulls, new tickers, late and corrected bars."""
    draw = random.Random(seed)
    tickers = ["^GSPC", "^VIX", *[f"T{i}" for i in range(6)]]
    price = {t: 20.0 if t == "^VIX" else 100.0 for t in tickers}
    late, batches, next_id = [], [], 1
    for d in range(days):
        batch = []
        for t in tickers:
            if t == "T5" and d < days // 3:
                continue  # not listed yet
            if draw.random() < (0.3 if t == "T4" else 0.08):
                continue
            price[t] = round(price[t] * (1 + draw.uniform(-0.04, 0.04)), 3) if t != "T3" or d % 9 else price[t]
            value = None if t not in ("^GSPC", "^VIX") and draw.random() < 0.04 else price[t]
            bar = (t, DAY0 + dt.timedelta(days=d), value)
            (late if draw.random() < 0.05 else batch).append(bar)
        if late and draw.random() < 0.4:
            batch.append(late.pop(0))
        if d and draw.random() < 0.25:  # a bar of the last days once more, with another price
            back = draw.choice([1, 2, 5, 25])
            batch.append((draw.choice(tickers[2:] if draw.random() < 0.7 else tickers), DAY0 + dt.timedelta(days=max(0, d - back)), round(draw.uniform(15, 110), 3)))
        batches.append([(next_id + i, *bar, 1) for i, bar in enumerate(batch)])
        next_id += len(batch)
    return batches


def full_panel(bars, params):
    return series.risk_panel(series.daily_returns(prices.clean_prices(bars)), params)


def same(a, b):
    key = lambda r: (r["ticker"], r["date"])
    a, b = sorted(a, key=key), sorted(b, key=key)
    assert list(map(key, a)) == list(map(key, b))
    for x, y in zip(a, b):
        for c in x.asDict():
            assert x[c] == y[c] or (x[c] is not None and y[c] is not None and x[c] == pytest.approx(y[c], rel=1e-9, abs=1e-12)), (c, x, y)


@pytest.fixture
def quick(spark):
    """Many small jobs: plans cost more than rows."""
    held = {"spark.sql.shuffle.partitions": "1"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("seed", "days", "together"), [(1, 60, 10), (2, 60, 20)])
def test_days_add_up_to_a_rebuild(spark, quick, seed, days, together):
    batches = simulated(seed, days)
    table = lambda rows, schema: spark.createDataFrame(rows, schema).coalesce(1)
    state, feats, so_far, deep_seen, steps = [], {}, [], 0, 0
    for d in range(0, days, together):
        batch = [bar for day in batches[d : d + together] for bar in day]
        so_far += batch
        if not batch:
            continue
        bars = table(so_far, BARS)
        held, changes = table(state, schemas.RISK_STATE), prices.clean_prices(table(batch, BARS))
        deep = {r["ticker"] for r in carried.deep_tickers(held, changes, SMALL).collect()}
        deep_seen += bool(deep)
        steps += 1
        shallow = ~F.col("ticker").isin(sorted(deep))
        rows = carried.advance(held, changes, SMALL).cache()
        new = features.risk_features(rows.filter(shallow & F.col("moved"))).collect()
        state = carried.state_of(rows.filter(shallow), SMALL).collect()
        if deep:
            panel = full_panel(bars, SMALL).filter(~shallow)
            new += features.risk_features(panel).collect()
            state += carried.state_of(panel, SMALL).collect()
        feats |= {(r["ticker"], r["date"]): r for r in new}
        if d + together >= days:
            want = {(r["ticker"], r["date"]): r for r in features.risk_features(full_panel(bars, SMALL)).collect()}
            same([feats[k] for k in want], list(want.values()))
    assert len(want) > 100 and deep_seen < steps  # a step of many days has a bar from far back more often than a day has
    per_ticker = max(sum(r["ticker"] == t for r in state) for t in {r["ticker"] for r in state})
    assert per_ticker <= 3 * carried.held_rows(SMALL)


def test_a_panel_is_sorted_once_for_its_state(spark):
    rows = [("T", DAY0 + dt.timedelta(days=i), i % 3 > 0, i % 4 > 0) for i in range(400)]
    panel = spark.createDataFrame(rows, "ticker string, date date, has_return boolean, has_beta_row boolean")
    for f in schemas.RISK_STATE:
        if f.name not in panel.columns:
            panel = panel.withColumn(f.name, F.lit(None).cast(f.dataType))
    panel = panel.drop("whole_returns", "whole_betas")
    state = carried.state_of(panel)
    most = carried.held_rows()
    newest = rows[::-1]
    want = set()
    for kind in (2, 3):
        for yes in (True, False):
            want |= {r[1] for r in [r for r in newest if r[kind] is yes][:most]}
    assert {r["date"] for r in state.collect()} == want
    plan = state._jdf.queryExecution().sparkPlan().toString() + state._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"\bSort \[", plan)) == 1

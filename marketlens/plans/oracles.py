"""The same results in SQL for DuckDB, written figure by figure with joins.

The Spark operators fold the figures into one pass; these do not, so the two
agree only if the folding is right. Divisors are guarded with nullif.
"""

from __future__ import annotations

import re

from marketlens.operators.forest import FEATURES, ForestParams
from marketlens.plans.queries import ABSENT, EARLIER_RUN_DAYS, PORTFOLIOS, SPOTLIGHT, STAND_IN_DRIFT, UNIVERSE
from marketlens.sources import watchlist as wl
from marketlens.sources.lineitem_bars import SYMBOLS


def _strings(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _layer(p: str, source: str) -> dict[str, str]:
    """Relations from bars to features; ``p`` prefixes their names."""
    w30 = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
    w5 = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
    return {
        f"{p}newest": f"""
            SELECT * FROM {source}
            QUALIFY row_number() OVER (PARTITION BY date, ticker ORDER BY id DESC) = 1""",
        f"{p}clean": f"SELECT date, ticker, adj_close, volume FROM {p}newest",
        f"{p}returns": f"""
            SELECT date, ticker, adj_close,
                   adj_close / nullif(lag(adj_close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1
                       AS daily_return
            FROM {p}clean""",
        f"{p}vol": f"""
            SELECT date, ticker,
                   sqrt(greatest((sum(daily_return * daily_return) OVER w
                       - pow(sum(daily_return) OVER w, 2) / 30.0) / 29.0, 0)) * sqrt(252)
                       AS annualized_volatility_30d
            FROM {p}returns WHERE daily_return IS NOT NULL WINDOW w AS {w30}""",
        f"{p}beta": f"""
            SELECT date, ticker,
                   (sum(s * m) OVER w - sum(s) OVER w * sum(m) OVER w / 30.0)
                   / nullif(sum(m * m) OVER w - pow(sum(m) OVER w, 2) / 30.0, 0) AS beta_30d
            FROM (SELECT a.date, a.ticker, a.daily_return AS s, b.daily_return AS m
                  FROM {p}returns a JOIN {p}returns b ON b.date = a.date
                  WHERE b.ticker = '^GSPC' AND a.ticker <> '^GSPC')
            WINDOW w AS {w30}""",
        f"{p}drift": f"""
            SELECT *, beta_30d_5d_ahead - beta_30d AS beta_30d_drift_5d
            FROM (SELECT *, lead(beta_30d, 5) OVER (PARTITION BY ticker ORDER BY date)
                             AS beta_30d_5d_ahead
                  FROM {p}beta WHERE beta_30d IS NOT NULL)""",
        f"{p}cumret": f"""
            SELECT date, ticker, daily_return,
                   exp(sum(CASE WHEN 1 + daily_return > 0 THEN ln(1 + daily_return) ELSE 0 END)
                       OVER {w5}) - 1 AS cumulative_return_5d
            FROM {p}returns WHERE daily_return IS NOT NULL""",
        f"{p}regime": f"""
            SELECT date, adj_close,
                   CASE WHEN adj_close < 15 THEN 0 WHEN adj_close <= 25 THEN 1
                        WHEN adj_close > 25 THEN 2 ELSE 3 END AS market_regime_vix
            FROM {p}clean WHERE ticker = '^VIX' AND adj_close IS NOT NULL""",
        f"{p}features": f"""
            SELECT d.ticker, d.date,
                   v.annualized_volatility_30d AS feat_rolling_vol_30d,
                   d.beta_30d AS feat_rolling_beta_130d,
                   c.cumulative_return_5d AS feat_cumulative_return_5d,
                   CAST(g.market_regime_vix AS DOUBLE) AS feat_market_regime_vix,
                   d.beta_30d_drift_5d AS target_beta_drift_5d
            FROM {p}drift d
            JOIN {p}vol v ON v.date = d.date AND v.ticker = d.ticker
            JOIN {p}cumret c ON c.date = d.date AND c.ticker = d.ticker
            JOIN {p}regime g ON g.date = d.date""",
        f"{p}metrics": f"""
            SELECT ticker, date, feat_rolling_beta_130d AS actual_beta_130d,
                   feat_rolling_vol_30d AS actual_vol_30d,
                   feat_cumulative_return_5d AS actual_return_5d,
                   CAST(feat_market_regime_vix AS INTEGER) AS vix_regime
            FROM {p}features
            WHERE date <= (SELECT DISTINCT date FROM {p}features ORDER BY date DESC
                           LIMIT 1 OFFSET 5)""",
    }


def _var_run(lookback: int, hour: int) -> str:
    return f"""
        SELECT h.ticker, h.last_date + INTERVAL {hour} HOUR AS ts,
               h.historical_var, h.parametric_var, s.monte_carlo_var
        FROM var_base_{lookback} h JOIN var_sim_{lookback} s ON s.ticker = h.ticker"""


_CTES: dict[str, str] = {
    "bars": f"""
        SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey % 1000000 AS id,
               ticker, date, price AS open, price + 1 AS high, price - 1 AS low,
               price AS close, price AS adj_close, volume
        FROM (SELECT *, CASE WHEN l_suppkey % 10 < 5 OR l_suppkey < 10
                             THEN [{_strings(SYMBOLS)}][CAST(l_suppkey % 10 AS INTEGER) + 1]
                             ELSE 'S' || l_suppkey END AS ticker,
                     CAST(l_shipdate AS DATE) AS date,
                     CASE WHEN l_suppkey % 10 = 1 THEN CAST(10 + l_orderkey % 26 AS DOUBLE)
                          ELSE 100 + l_quantity + l_discount END AS price,
                     CAST(floor(l_extendedprice) AS BIGINT) AS volume
              FROM lineitem)""",
    "today": "SELECT max(date) AS d FROM bars",
    **_layer("", "bars"),
    "kept_bars": "SELECT * FROM bars WHERE date >= (SELECT d - 1095 FROM today)",
    **_layer("kept_", "kept_bars"),
    "early_bars": f"SELECT * FROM bars WHERE date < (SELECT d - {EARLIER_RUN_DAYS} FROM today)",
    **_layer("early_", "early_bars"),
    "named": f"SELECT DISTINCT ticker FROM bars UNION ALL SELECT '{ABSENT}'",
    "correlated": """
        SELECT a.ticker AS ticker_x, b.ticker AS ticker_y, count(*) AS days,
               round(CASE WHEN count(*) >= 2 THEN covar_pop(a.daily_return, b.daily_return)
                     / nullif(stddev_pop(a.daily_return) * stddev_pop(b.daily_return), 0) END, 6) + 0.0 AS correlation
        FROM returns a JOIN returns b ON b.date = a.date AND a.ticker <= b.ticker
        WHERE a.daily_return IS NOT NULL AND b.daily_return IS NOT NULL
        GROUP BY a.ticker, b.ticker""",
    "open_features": f"""
        SELECT *, {STAND_IN_DRIFT} * feat_rolling_beta_130d AS predicted_drift
        FROM features WHERE target_beta_drift_5d IS NULL""",
    "predictions": f"""
        SELECT (date - DATE '1970-01-01') * 1000000000
                   + coalesce(nullif(list_position([{_strings(SYMBOLS)}], ticker), 0),
                              10 + TRY_CAST(substr(ticker, 2, 9) AS BIGINT)) * 10 + run AS prediction_id,
               strftime(date + to_hours(run), '%Y-%m-%d %H:%M:%S') AS prediction_timestamp,
               ticker, date AS forecast_date, feat_rolling_beta_130d AS base_beta_130d,
               predicted_drift * run AS predicted_drift,
               feat_rolling_beta_130d + predicted_drift * run AS predicted_beta_final,
               'run-' || run AS model_version
        FROM open_features, (VALUES (1), (2)) runs(run)""",
    "last_predictions": """
        SELECT * FROM predictions
        WHERE forecast_date = (SELECT max(forecast_date) FROM predictions)
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY prediction_id DESC) = 1""",
    **{
        name: text
        for n in (252, 126)
        for name, text in {
            f"recent_{n}": f"""
                SELECT * FROM (
                    SELECT * FROM returns
                    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= {n})
                WHERE daily_return IS NOT NULL""",
            f"var_base_{n}": f"""
                SELECT ticker, max(date) AS last_date,
                       quantile_cont(daily_return, 0.05) AS historical_var,
                       avg(daily_return) - 1.6448536269514722 * stddev_pop(daily_return)
                           AS parametric_var,
                       avg(daily_return) AS mu, stddev_pop(daily_return) AS sigma
                FROM recent_{n} GROUP BY ticker""",
            f"var_sim_{n}": f"""
                SELECT ticker, quantile_cont(
                           mu + sigma * sqrt(-2 * ln(u1)) * cos(2 * pi() * u2), 0.05)
                           AS monte_carlo_var
                FROM (SELECT ticker, mu, sigma,
                             (xor(u // 65536, u) + 0.5::DOUBLE) / 4294967296 AS u1,
                             (xor(v // 65536, v) + 0.5::DOUBLE) / 4294967296 AS u2
                      FROM (SELECT * REPLACE (xor(u // 65536, u) * 73244475 % 4294967296 AS u,
                                              xor(v // 65536, v) * 73244475 % 4294967296 AS v)
                      FROM (SELECT * REPLACE (xor(u // 65536, u) * 73244475 % 4294967296 AS u,
                                              xor(v // 65536, v) * 73244475 % 4294967296 AS v)
                      FROM (SELECT ticker, mu, sigma,
                                   (CAST('0x' || substr(h, 1, 8) AS BIGINT) + i) % 4294967296 AS u,
                                   (CAST('0x' || substr(h, 9, 8) AS BIGINT) + i) % 4294967296 AS v
                            FROM (SELECT *, md5(ticker || '|42') AS h FROM var_base_{n}),
                                 range(10000) draws(i)))))
                GROUP BY ticker""",
        }.items()
    },
    "var_table": _var_run(252, 9) + " UNION ALL " + _var_run(126, 17),
    "last_var": """
        SELECT * FROM var_table
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM var_table)
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY ts DESC) = 1""",
    "panel": """
        SELECT v.date, v.ticker, v.annualized_volatility_30d, b.beta_30d, r.adj_close,
               r.daily_return
        FROM vol v
        JOIN beta b ON b.date = v.date AND b.ticker = v.ticker
        JOIN returns r ON r.date = v.date AND r.ticker = v.ticker""",
    "weights": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{name}', '{ticker}', {weight}::DOUBLE, {len(members)})"
        for name, members in PORTFOLIOS.items()
        for ticker, weight in members.items()
    )
    + ") w(portfolio, ticker, weight, members)",
    "portfolio_days": """
        SELECT w.portfolio, r.date, sum(w.weight * r.daily_return) AS ret
        FROM returns r JOIN weights w ON w.ticker = r.ticker
        WHERE r.daily_return IS NOT NULL
        GROUP BY w.portfolio, r.date HAVING count(*) = max(w.members)""",
    "portfolio_windows": """
        SELECT portfolio, date,
               exp(sum(CASE WHEN 1 + ret > 0 THEN ln(1 + ret) ELSE 0 END) OVER w) - 1 AS loss,
               count(*) OVER w AS rows_seen
        FROM portfolio_days
        WINDOW w AS (PARTITION BY portfolio ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "funds": f"""
        SELECT portfolio, ticker, sum(weight) AS weight FROM (
            SELECT DISTINCT 'F' || l_suppkey AS portfolio, 0.5 AS weight,
                   CASE WHEN l_suppkey % 10 < 5 OR l_suppkey < 10
                        THEN [{_strings(SYMBOLS)}][CAST(l_suppkey % 10 AS INTEGER) + 1] ELSE 'S' || l_suppkey END AS ticker
            FROM lineitem
            UNION ALL SELECT DISTINCT 'F' || l_suppkey, 0.5, '^GSPC' FROM lineitem)
        GROUP BY portfolio, ticker""",
    "fund_days": """
        SELECT portfolio, date, sum(weight * daily_return) AS ret
        FROM returns JOIN funds USING (ticker) JOIN (SELECT portfolio, count(*) AS members FROM funds GROUP BY portfolio) USING (portfolio)
        WHERE daily_return IS NOT NULL
        GROUP BY portfolio, date HAVING count(*) = max(members)""",
    "fund_windows": """
        SELECT portfolio, date,
               exp(sum(CASE WHEN 1 + ret > 0 THEN ln(1 + ret) ELSE 0 END) OVER w) - 1 AS loss,
               count(*) OVER w AS rows_seen
        FROM fund_days
        WINDOW w AS (PARTITION BY portfolio ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
}


def _with(body: str) -> str:
    """Prepend the relations a query mentions, and those they mention, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\b[a-z_0-9]+\b", todo.pop()))
        fresh = {n for n in _CTES if n in words} - needed
        needed |= fresh
        todo += [_CTES[n] for n in fresh]
    parts = [f"{n} AS ({_CTES[n]})" for n in _CTES if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _r(expr: str, name: str | None = None) -> str:
    return f"round({expr}, 6) + 0.0::DOUBLE AS {name or expr.split('.')[-1]}"


_BAR = ", ".join(["ticker", "date", *map(_r, ("open", "high", "low", "close", "adj_close")), "volume"])
_FEATURES = ", ".join(
    [
        "ticker",
        "date",
        *map(
            _r,
            (
                "feat_rolling_vol_30d",
                "feat_rolling_beta_130d",
                "feat_cumulative_return_5d",
                "feat_market_regime_vix",
                "target_beta_drift_5d",
            ),
        ),
    ]
)
_METRICS = (
    f"ticker, date, {_r('actual_beta_130d')}, {_r('actual_vol_30d')}, "
    f"{_r('actual_return_5d')}, vix_regime"
)


_VAR_TEXT = """'95% Daily VaR: ' || CAST(round(CAST(round(abs(historical_var) * 100, 8) AS DECIMAL(28, 8)), 2)
                    AS DECIMAL(28, 2)) || '% (Historical)'"""


def _backfill(shift: str) -> str:
    return f"""
        SELECT ticker, forecast_date, {_r('predicted_beta_final')},
               {_r('actual', 'actual_beta_realized')},
               {_r('actual - predicted_beta_final', 'prediction_error')}
        FROM (SELECT f.ticker, f.date AS forecast_date,
                     f.feat_rolling_beta_130d + {STAND_IN_DRIFT} * f.feat_rolling_beta_130d
                         AS predicted_beta_final,
                     coalesce(CASE WHEN f.feat_market_regime_vix = 2
                                   THEN f.feat_rolling_beta_130d END, b.moved) AS actual
              FROM features f
              LEFT JOIN (SELECT ticker, date, {shift}(beta_30d, 5)
                                    OVER (PARTITION BY ticker ORDER BY date) AS moved FROM beta) b
                ON b.ticker = f.ticker AND b.date = f.date)"""


_PANIC = """
    SELECT period_start, period_end, days, peak_vix FROM (
        SELECT min(date) AS period_start, max(date) AS period_end, count(*) AS days,
               round(max(adj_close), 6) AS peak_vix
        FROM (SELECT date, adj_close, adj_close >= 20 AS panic,
                     sum(CASE WHEN adj_close >= 20 THEN 0 ELSE 1 END)
                         OVER (ORDER BY date) AS calm_days_before
              FROM clean WHERE ticker = '^VIX')
        WHERE panic GROUP BY calm_days_before)"""

_BODIES: dict[str, str] = {
    "watchlist_filter": f"SELECT date, ticker, {_r('adj_close')}, volume FROM clean WHERE ticker IN ({_strings(UNIVERSE)})",
    "bronze_landing_scan": f"SELECT id, {_BAR} FROM bars WHERE date >= DATE '1997-01-01' AND date < DATE '2000-01-01' AND ticker IN ({_strings(wl.ingest_set(watchlist=wl.DEFAULT_WATCHLIST))})",
    "bronze_wide_to_long": f"SELECT {_BAR} FROM newest WHERE ticker IN ({_strings(SYMBOLS)})",
    "bronze_numbering": """
        SELECT ticker, count(*) AS bars, count(*) AS ids, true AS above_the_batch_before
        FROM bars GROUP BY ticker""",
    "views_in_sql": f"""
        SELECT ticker, count(*) AS days, {_r('max(annualized_volatility_30d)', 'highest_volatility')},
               {_r('min(beta_30d)', 'lowest_beta')}, {_r('max(ln(adj_close))', 'highest_log_price')}
        FROM panel GROUP BY ticker""",
    "bronze_dedup": f"SELECT id, {_BAR} FROM newest",
    "archive_rows": f"SELECT id, {_BAR} FROM bars WHERE date < (SELECT d - 1095 FROM today)",
    "retained_rows": f"SELECT id, {_BAR} FROM bars WHERE date >= (SELECT d - 1095 FROM today)",
    "stored_tables": """
        SELECT table_name, columns, ticker, count(*) AS rows, min(day) AS first_day, max(day) AS last_day
        FROM (SELECT 'bronze_price_history' AS table_name, 10 AS columns, ticker, date AS day FROM clean
              UNION ALL
              SELECT 'gold_risk_inference', 10, ticker, forecast_date FROM predictions
              UNION ALL
              SELECT 'gold_risk_var_summary', 6, ticker, CAST(ts AS DATE)
              FROM var_table)
        GROUP BY ALL""",
    "safe_math": f"""
        SELECT {_r('x')}, rows,
               {_r('CASE WHEN x > 0 THEN sqrt(x) ELSE 0 END', 'sqrt_x')},
               {_r('CASE WHEN x > 0 THEN ln(x) ELSE 0 END', 'ln_x')},
               {_r('CASE WHEN x IS NULL THEN 0 ELSE pow(x, 2) END', 'pow_x_2')},
               {_r('coalesce(exp(x / 10), 0)', 'exp_x_10')},
               {_r('1 / nullif(x, 0)', 'one_by_x')}
        FROM (SELECT CASE WHEN l_linenumber <> 7 THEN l_quantity - 25 END AS x, count(*) AS rows
              FROM lineitem GROUP BY 1)""",
    "silver_price_history_clean": f"SELECT date, ticker, {_r('adj_close')}, volume FROM clean",
    "silver_returns": f"SELECT date, ticker, {_r('adj_close')}, {_r('daily_return')} FROM returns",
    "silver_rolling_volatility": f"SELECT date, ticker, {_r('annualized_volatility_30d')} FROM vol",
    "gold_rolling_beta_30d": f"SELECT date, ticker, {_r('beta_30d')} FROM beta",
    "gold_max_drawdown": f"""
        SELECT ticker, {_r('min((adj_close - peak) / nullif(peak, 0) * 100)', 'max_drawdown_pct')},
               {_r('max(peak)', 'cycle_high')}, {_r('min(adj_close)', 'cycle_low')}
        FROM (SELECT *, max(adj_close) OVER (PARTITION BY ticker ORDER BY date) AS peak FROM clean)
        GROUP BY ticker""",
    "drawdown_merged": f"""
        SELECT ticker, {_r('min((adj_close - peak) / nullif(peak, 0) * 100)', 'max_drawdown_pct')},
               {_r('max(peak)', 'cycle_high')}, {_r('min(adj_close)', 'cycle_low')}
        FROM (SELECT *, max(adj_close) OVER (PARTITION BY ticker ORDER BY date) AS peak FROM clean)
        GROUP BY ticker""",
    "gold_beta_30d_drift_5d": f"SELECT date, ticker, {_r('beta_30d')}, {_r('beta_30d_5d_ahead')}, {_r('beta_30d_drift_5d')} FROM drift",
    "gold_cum_return_5d": f"SELECT date, ticker, {_r('daily_return')}, {_r('cumulative_return_5d')} FROM cumret",
    "gold_market_regime_vix": f"SELECT date, {_r('adj_close')}, market_regime_vix FROM regime",
    "gold_rolling_volume_30d": f"""
        SELECT date, ticker, volume,
               {_r('avg(volume) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)', 'rolling_volume_30d')}
        FROM clean WHERE volume IS NOT NULL""",
    "gold_recent_risk_inference": f"""
        SELECT ticker, forecast_date, prediction_id, prediction_timestamp,
               {_r('base_beta_130d')}, {_r('predicted_drift')}, {_r('predicted_beta_final')},
               model_version, CAST(NULL AS DOUBLE) AS actual_beta_realized,
               CAST(NULL AS DOUBLE) AS prediction_error
        FROM last_predictions""",
    "gold_recent_risk_var_summary": f"""
        SELECT ticker, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
               {_r('historical_var')}, {_r('parametric_var')}, {_r('monte_carlo_var')},
               {_VAR_TEXT} AS display_text
        FROM last_var""",
    "risk_features_new": f"SELECT {_FEATURES} FROM features",
    "features_from_state": f"SELECT {_FEATURES} FROM features",
    "silver_risk_features_merge": f"""
        SELECT {_FEATURES} FROM (
            SELECT * FROM kept_features
            UNION ALL
            SELECT * FROM early_features e
            WHERE NOT EXISTS (SELECT 1 FROM kept_features k
                              WHERE k.ticker = e.ticker AND k.date = e.date))""",
    "gold_risk_metrics": f"SELECT {_METRICS} FROM metrics",
    "gold_risk_metrics_append": f"""
        SELECT {_METRICS} FROM metrics m
        WHERE NOT EXISTS (SELECT 1 FROM early_metrics e
                          WHERE e.ticker = m.ticker AND e.date = m.date)""",
    "inference_backfill_forward": _backfill("lead"),
    "inference_backfill_as_coded": _backfill("lag"),
    "feature_split_counts": """
        SELECT ticker, CASE WHEN target_beta_drift_5d IS NULL THEN 'inference' ELSE 'train' END AS split,
               count(*) AS rows
        FROM features GROUP BY 1, 2""",
    "beta_drift_forecast_panel": f"""
        SELECT ticker, date, {_r('feat_rolling_beta_130d', 'current_beta')},
               {_r('feat_rolling_beta_130d + predicted_drift', 'forecast_beta')}
        FROM open_features WHERE ticker IN ({_strings(SPOTLIGHT)})""",
    # judged at six in the evening of the newest day
    "quality_gate": """
        SELECT *, latest_date::TIMESTAMP < (SELECT d FROM today) - INTERVAL 30 HOUR AS stale,
               null_predictions = 0 AND latest_date::TIMESTAMP >= (SELECT d FROM today) - INTERVAL 30 HOUR AS passed
        FROM (SELECT count(*) AS rows,
                     count(*) FILTER (predicted_drift IS NULL) AS null_predictions,
                     count(*) FILTER (feat_rolling_beta_130d > 4.0) AS extreme_betas,
                     max(date) AS latest_date
              FROM open_features)""",
    # the forest itself is beyond SQL: what must hold of any that is fitted on these rows
    "forest_training_fit": f"""
        SELECT count(*) AS train_rows, {_r('stddev_pop(target_beta_drift_5d)', 'rmse_constant')}, true AS beats_constant
        FROM features WHERE target_beta_drift_5d IS NOT NULL""",
    "risk_inference_predict": f"""
        SELECT ticker, date AS forecast_date, {_r('feat_rolling_beta_130d', 'base_beta_130d')},
               '{ForestParams.version}' AS model_version, true AS drift_among_targets,
               true AS final_is_base_plus_drift, count(*) OVER () AS predictions,
               1::BIGINT AS first_id, count(*) OVER () AS last_id
        FROM features WHERE target_beta_drift_5d IS NULL""",
    "feature_importance": f"""
        SELECT unnest([{_strings(FEATURES)}]) AS feature, true AS within_0_and_1, true AS weights_add_up_to_1""",
    "stock_risk_panel": f"SELECT date, ticker, {_r('annualized_volatility_30d')}, {_r('beta_30d')}, {_r('adj_close')} FROM panel",
    "stock_risk_panic_panel": f"""
        SELECT p.date, p.ticker, {_r('p.annualized_volatility_30d')}, {_r('p.beta_30d')},
               {_r('p.adj_close')}, {_r('x.adj_close', 'vix_price')}, x.adj_close >= 20 AS panic
        FROM panel p JOIN clean x ON x.date = p.date AND x.ticker = '^VIX'""",
    "panic_periods": _PANIC,
    "correlation_matrix": f"""
        SELECT x.ticker AS ticker_x, y.ticker AS ticker_y, coalesce(days, 0) AS days, correlation
        FROM named x JOIN named y ON x.ticker <= y.ticker
        LEFT JOIN correlated c ON c.ticker_x = x.ticker AND c.ticker_y = y.ticker""",
    "correlation_merged": "SELECT * FROM correlated",
    "vix_latest_regime": f"""
        SELECT date, {_r('adj_close', 'current_level')}, market_regime_vix,
               CASE market_regime_vix WHEN 0 THEN 'Quiet (Low Volatility)'
                    WHEN 1 THEN 'Standard (Moderate Risk)'
                    ELSE 'Stress (High Risk/Panic)' END AS regime_label
        FROM regime ORDER BY date DESC LIMIT 1""",
    "risk_matrix": f"""
        SELECT ticker, {_r('mc_var')}, {_r('pred_beta')}, forecast_date,
               CASE WHEN pred_beta > beta_mid AND mc_var > var_mid THEN 'High Beta / High VaR (Aggressive)'
                    WHEN pred_beta > beta_mid THEN 'High Beta / Low VaR (Efficient)'
                    WHEN mc_var > var_mid THEN 'Low Beta / High VaR (Outlier Risk)'
                    ELSE 'Low Beta / Low VaR (Defensive)' END AS risk_category
        FROM (SELECT *, median(pred_beta) OVER () AS beta_mid, median(mc_var) OVER () AS var_mid
              FROM (SELECT v.ticker, v.monte_carlo_var AS mc_var,
                           p.predicted_beta_final AS pred_beta, p.forecast_date
                    FROM last_var v JOIN last_predictions p ON p.ticker = v.ticker
                    WHERE v.ticker IN ({_strings(UNIVERSE)})))""",
    "var_historical": f"SELECT ticker, {_r('historical_var')} FROM var_base_252",
    "var_parametric": f"SELECT ticker, {_r('parametric_var')} FROM var_base_252",
    "var_monte_carlo": f"SELECT ticker, {_r('monte_carlo_var')} FROM var_sim_252",
    "var_summary": f"""
        SELECT h.ticker, {_r('h.historical_var')}, {_r('h.parametric_var')}, {_r('s.monte_carlo_var')},
               {_VAR_TEXT} AS display_text
        FROM var_base_252 h JOIN var_sim_252 s ON s.ticker = h.ticker
        WHERE h.ticker IN ({_strings(UNIVERSE)})""",
    "sma_20_50": "SELECT date, ticker, "
    + _r("adj_close")
    + "".join(
        ", "
        + _r(
            f"CASE WHEN row_number() OVER (PARTITION BY ticker ORDER BY date) >= {n} THEN "
            f"avg(adj_close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} "
            f"PRECEDING AND CURRENT ROW) END",
            f"sma_{n}",
        )
        for n in (20, 50)
    )
    + " FROM clean",
    "portfolio_stress_5d": f"""
        SELECT portfolio, count(*) AS windows, {_r('min(loss)', 'worst_return_5d')},
               arg_min(date, loss) AS worst_date
        FROM portfolio_windows WHERE rows_seen = 5 GROUP BY portfolio""",
    "portfolio_stress_table": f"""
        SELECT portfolio, count(*) AS windows, {_r('min(loss)', 'worst_return_5d')},
               arg_min(date, {{'l': loss, 'd': date}}) AS worst_date
        FROM fund_windows WHERE rows_seen = 5 GROUP BY portfolio""",
    "idiosyncratic_divergence": f"""
        SELECT date, ticker, {_r('daily_return')}, {_r('residual')}, {_r('daily_sigma')},
               abs(residual) > 2 * daily_sigma AS diverges
        FROM (SELECT p.date, p.ticker, p.daily_return,
                     p.daily_return - p.beta_30d * m.daily_return AS residual,
                     p.annualized_volatility_30d / sqrt(252) AS daily_sigma
              FROM panel p
              JOIN returns m ON m.date = p.date AND m.ticker = '^GSPC'
              JOIN returns x ON x.date = p.date AND x.ticker = '^VIX'
              WHERE abs(x.daily_return) <= 0.02)
        WHERE residual IS NOT NULL""",
}


def oracle_texts() -> dict[str, str]:
    return {name: _with(body) for name, body in _BODIES.items()}

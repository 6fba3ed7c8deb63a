"""The registered queries in DuckDB's SQL, written independently of the Spark plans.

Each query is a SELECT over named steps (CTEs); ``sql`` puts the steps that a
query needs in front of it. Money and percentages are rounded in integers.
"""

from __future__ import annotations

import re

DAYS_AHEAD = 30


def places(expr: str, digits: int) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def decimal_places(expr: str, digits: int) -> str:
    """For quantiles and means of values with two places: these are short decimals, and often halves."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def half_up(num: str, den: str) -> str:
    """num / den for non-negative integers, halves up."""
    return f"((2*({num}) + ({den})) // (2*({den})))"


def scaled(units: str, digits: int) -> str:
    return f"(CAST({units} AS DOUBLE) / 1e{digits})"


def units(col: str, digits: int) -> str:
    return f"CAST(round({col} * 1e{digits}) AS BIGINT)"


def mean_of(col: str, digits: int, over: str = "") -> str:
    u = units(col, digits)
    return scaled(half_up(f"sum({u}) {over}", f"count({u}) {over}"), digits)


def sum_of(col: str, have: int, want: int) -> str:
    return scaled(half_up(f"sum({units(col, have)})", str(10 ** (have - want))), want)


def percent(part: str, whole: str) -> str:
    return scaled(half_up(f"10000*({part})", whole), 2)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


MODEL_OF_EVENT = "CASE event_id % 3 WHEN 0 THEN 'gpt-4o' WHEN 1 THEN 'gpt-3.5-turbo' ELSE 'claude-3-sonnet' END"
ROW7_TEAM = "OVER (PARTITION BY team ORDER BY event_date NULLS FIRST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
ROW7_MODEL = "OVER (PARTITION BY model ORDER BY feedback_date NULLS FIRST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


def cleaned(source: str) -> str:
    return f"""
SELECT call_id, trim(team) AS team, trim(feature) AS feature, trim(model) AS model,
       trim(environment) AS environment, prompt_tokens, completion_tokens, latency_ms, trim(status) AS status,
       status_code, user_id, TRY_CAST("timestamp" AS TIMESTAMP) AS event_timestamp,
       CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS event_date,
       CAST(prompt_tokens AS BIGINT) + completion_tokens AS total_tokens,
       coalesce(latency_ms > 3000, false) AS is_slow, coalesce(trim(status) = 'error', false) AS is_error
FROM {source}"""


def priced(source: str) -> str:
    return f"""
SELECT c.*, CAST(round((CAST(prompt_tokens AS DECIMAL(12,0)) * p + CAST(completion_tokens AS DECIMAL(12,0)) * q)
                       * CAST(0.001 AS DECIMAL(4,3)), 6) * 1000000 AS BIGINT) AS micros
FROM {source} c LEFT JOIN prices USING (model)
WHERE call_id IS NOT NULL AND prompt_tokens > 0 AND latency_ms >= 0
  AND team IN ('product','data','marketing','ops','finance')
  AND model IN ('gpt-4o','gpt-3.5-turbo','claude-3-sonnet')"""


def lag(col: str, k: int, key: str = "team", day: str = "event_date") -> str:
    return f"lag({col}, {k}) OVER (PARTITION BY {key} ORDER BY {day})"


def before(agg: str, k: int, key: str = "team", day: str = "event_date") -> str:
    return f"{agg} OVER (PARTITION BY {key} ORDER BY {day} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"


def calendar(day: str) -> str:
    return f"""CAST(isodow({day}) - 1 AS INTEGER) AS day_of_week, CAST(day({day}) AS INTEGER) AS day_of_month,
 CAST(month({day}) AS INTEGER) AS "month", CAST(week({day}) AS INTEGER) AS week_of_year,
 CASE WHEN isodow({day}) >= 6 THEN 1 ELSE 0 END AS is_weekend"""


TEAM_CODE = "CASE team WHEN 'product' THEN 0 WHEN 'data' THEN 1 WHEN 'marketing' THEN 2 WHEN 'ops' THEN 3 WHEN 'finance' THEN 4 END AS team_encoded"
LAGS = (1, 3, 7, 14, 30)

STEPS = {
    "calls": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS call_id,
 CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T06:47:09Z' AS "timestamp",
 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'product' WHEN 'BUILDING' THEN 'data' WHEN 'FURNITURE' THEN 'marketing' WHEN 'HOUSEHOLD' THEN 'ops' WHEN 'MACHINERY' THEN 'finance' END AS team,
 'feature_' || CAST(l_partkey % 10 AS VARCHAR) AS feature,
 CASE l_returnflag WHEN 'A' THEN 'gpt-4o' WHEN 'N' THEN 'gpt-3.5-turbo' WHEN 'R' THEN 'claude-3-sonnet' END AS model,
 CASE WHEN l_linestatus = 'F' THEN 'prod' ELSE 'dev' END AS environment,
 CAST(l_quantity AS INTEGER) * 40 AS prompt_tokens, CAST(l_quantity AS INTEGER) * 12 AS completion_tokens,
 CAST(l_partkey % 40 AS INTEGER) * 100 AS latency_ms,
 CASE WHEN l_suppkey % 25 = 0 THEN 'error' ELSE 'success' END AS status,
 CASE WHEN l_suppkey % 25 = 0 THEN 500 ELSE 200 END AS status_code,
 'user_' || CAST(o_custkey AS VARCHAR) AS user_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "calls_dirty": """
SELECT CASE WHEN CAST(split_part(call_id, '-', 1) AS BIGINT) % 101 = 0 THEN NULL ELSE call_id END AS call_id,
 CASE WHEN latency_ms = 3900 AND prompt_tokens = 2000 THEN 'not-a-time' ELSE "timestamp" END AS "timestamp",
 CASE WHEN latency_ms = 100 THEN '  ' || team || ' ' WHEN latency_ms = 200 AND prompt_tokens < 200 THEN 'unknown' ELSE team END AS team,
 feature,
 CASE WHEN latency_ms = 300 THEN model || ' ' WHEN latency_ms = 400 AND prompt_tokens < 200 THEN 'other-model' WHEN latency_ms = 500 AND prompt_tokens < 200 THEN NULL ELSE model END AS model,
 environment,
 CASE WHEN latency_ms = 600 AND prompt_tokens < 400 THEN 0 ELSE prompt_tokens END AS prompt_tokens,
 CASE WHEN latency_ms = 700 AND prompt_tokens < 400 THEN NULL ELSE completion_tokens END AS completion_tokens,
 CASE WHEN latency_ms = 800 AND prompt_tokens < 400 THEN -1 ELSE latency_ms END AS latency_ms,
 status, status_code, user_id
FROM calls""",
    "prices": """
SELECT * FROM (VALUES ('gpt-4o', CAST(0.0050 AS DECIMAL(10,4)), CAST(0.0150 AS DECIMAL(10,4))),
 ('gpt-3.5-turbo', 0.0005, 0.0015), ('claude-3-sonnet', 0.0030, 0.0150)) AS t(model, p, q)""",
    "cleaned": cleaned("calls"),
    "silver": priced("cleaned"),
    "cleaned_dirty": cleaned("calls_dirty"),
    "silver_dirty": priced("cleaned_dirty"),
    "fine_prices": """
SELECT CASE p_partkey % 3 WHEN 0 THEN 'gpt-4o' WHEN 1 THEN 'gpt-3.5-turbo' ELSE 'claude-3-sonnet' END AS model,
 CASE WHEN p_partkey % 3 = 2 THEN 2 ELSE p_partkey % 4 END AS kind, p_size, p_partkey FROM part""",
    "best_prices": """
SELECT model, max(CAST('0.00500000000' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DECIMAL(18,14))) AS p,
 CAST(0.0000000000004 AS DECIMAL(18,14)) AS q
FROM fine_prices WHERE kind = 0 GROUP BY model""",
    "silver_fine": """
SELECT c.*, CAST(round((CAST(prompt_tokens AS DECIMAL(12,0)) * p + CAST(completion_tokens AS DECIMAL(12,0)) * q)
                       * CAST(0.001 AS DECIMAL(4,3)), 6) * 1000000 AS BIGINT) AS micros
FROM cleaned c LEFT JOIN best_prices USING (model)""",
    "live": """
SELECT * EXCLUDE ("timestamp"), "timestamp", CASE WHEN environment = 'dev' THEN make_timestamp(CAST(prompt_tokens AS BIGINT) * 1000000) END AS kafka_timestamp
FROM calls WHERE environment = 'prod' OR latency_ms <> 900""",
    "cleaned_live": cleaned("live").replace(" AS is_error\n", " AS is_error, kafka_timestamp\n"),
    "silver_live": priced("cleaned_live"),
    "feedback": f"""
SELECT CAST(ts AS DATE) AS feedback_date, {MODEL_OF_EVENT} AS model, CASE WHEN value < 100 THEN 1 ELSE 0 END AS thumbs_up
FROM events""",
    "feedback_dirty": f"""
SELECT CASE WHEN user_id % 20 = 4 THEN 'someday' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS "date",
 CASE user_id % 20 WHEN 0 THEN ' ' || {MODEL_OF_EVENT} WHEN 1 THEN 'other-model' ELSE {MODEL_OF_EVENT} END AS model,
 CASE user_id % 20 WHEN 2 THEN 'up' WHEN 3 THEN '2' WHEN 7 THEN '0.5' WHEN 5 THEN CASE WHEN value < 100 THEN '1.0' ELSE '0.0' END
  WHEN 6 THEN CASE WHEN value < 100 THEN ' 1' ELSE ' 0' END ELSE CASE WHEN value < 100 THEN '1' ELSE '0' END END AS thumbs_up
FROM events""",
    "daily_sums": """
SELECT event_date, team, sum(micros) AS m, count(micros) AS n, count(*) AS calls, sum(latency_ms) AS lat,
 count_if(is_error) AS errors, count_if(is_slow) AS slow, sum(total_tokens) AS tokens
FROM silver GROUP BY event_date, team""",
    "daily_flat": f"""
SELECT event_date, team, {scaled(half_up('m', '100'), 4)} AS total_cost_usd, calls AS total_calls,
 {scaled(half_up('m', 'n'), 6)} AS avg_cost_per_call, CAST({half_up('lat', 'calls')} AS DOUBLE) AS avg_latency_ms,
 {big('errors')} AS error_count, {big('slow')} AS slow_call_count, {big('tokens')} AS total_tokens_used
FROM daily_sums""",
    "daily": f"SELECT *, {mean_of('total_cost_usd', 4, ROW7_TEAM)} AS rolling_7d_avg_cost FROM daily_flat",
    "perf": f"""
SELECT event_date, model, count(*) AS total_calls, CAST({half_up('sum(latency_ms)', 'count(*)')} AS DOUBLE) AS avg_latency_ms,
 {scaled(half_up('sum(micros)', '100'), 4)} AS total_cost_usd, {scaled(half_up('sum(micros)', 'count(micros)'), 6)} AS avg_cost_per_call,
 {big('sum(total_tokens)')} AS total_tokens, {percent('count_if(is_error)', 'count(*)')} AS error_rate_pct,
 {percent('count_if(is_slow)', 'count(*)')} AS slow_call_rate_pct, count(DISTINCT user_id) AS unique_users
FROM silver GROUP BY event_date, model""",
    "breakdown": f"""
SELECT event_date, team, feature, model, count(*) AS total_calls, {scaled(half_up('sum(micros)', '100'), 4)} AS total_cost_usd,
 CAST({half_up('sum(latency_ms)', 'count(*)')} AS DOUBLE) AS avg_latency_ms, {big('sum(total_tokens)')} AS total_tokens,
 {big('count_if(is_error)')} AS error_count
FROM silver GROUP BY event_date, team, feature, model""",
    "quality_flat": f"""
SELECT feedback_date, model, count(*) AS total_feedback, {big('sum(thumbs_up)')} AS thumbs_up_count,
 {percent('sum(thumbs_up)', 'count(*)')} AS quality_score_pct
FROM feedback GROUP BY feedback_date, model""",
    "quality": f"SELECT *, {mean_of('quality_score_pct', 2, ROW7_MODEL)} AS rolling_7d_quality_score FROM quality_flat",
    "cost_raw": f"""
SELECT *, {calendar('event_date')}, {', '.join(f"{lag('total_cost_usd', k)} AS cost_lag_{k}d" for k in LAGS)},
 {before('avg(total_cost_usd)', 7)} AS rolling_mean_7d, {before('avg(total_cost_usd)', 14)} AS rolling_mean_14d,
 coalesce({before('stddev_samp(total_cost_usd)', 7)}, 0) AS rolling_std_7d, {TEAM_CODE}
FROM daily""",
    "cost_feat": "SELECT * FROM cost_raw WHERE COLUMNS(*) IS NOT NULL",
    "split": """
SELECT *, CASE WHEN event_date > (SELECT max(event_date) FROM cost_feat) - INTERVAL 14 DAY THEN 'test' ELSE 'train' END AS split
FROM cost_feat""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY team ORDER BY event_date DESC) AS back FROM cost_feat",
    "profile": f"""
SELECT team, {', '.join(f"coalesce(max(total_cost_usd) FILTER (back = {k}), avg(total_cost_usd)) AS cost_lag_{k}d" for k in LAGS)},
 avg(total_cost_usd) FILTER (back <= 7) AS rolling_mean_7d, avg(total_cost_usd) FILTER (back <= 14) AS rolling_mean_14d,
 coalesce(stddev_samp(total_cost_usd) FILTER (back <= 7), 0) AS rolling_std_7d,
 avg(total_calls) FILTER (back <= 7) AS total_calls, max(rolling_7d_avg_cost) FILTER (back = 1) AS rolling_7d_avg_cost
FROM ranked GROUP BY team""",
    "ahead": f"""
SELECT profile.*, CAST(d AS INTEGER) AS prediction_horizon_days,
 CAST((SELECT max(event_date) FROM daily) + CAST(d AS INTEGER) AS DATE) AS prediction_date
FROM profile CROSS JOIN range(1, {DAYS_AHEAD + 1}) AS r(d)""",
    "predictions": f"""
SELECT prediction_date, team, {places('rolling_mean_7d', 6)} AS predicted_cost_usd, prediction_horizon_days FROM ahead""",
    "quality_raw": f"""
SELECT *, quality_score_pct - rolling_7d_quality_score AS deviation_from_7d_avg,
 (quality_score_pct - avg(quality_score_pct) OVER (PARTITION BY model))
   / (stddev_samp(quality_score_pct) OVER (PARTITION BY model) + 1e-8) AS z_score,
 coalesce({before('stddev_samp(quality_score_pct)', 7, 'model', 'feedback_date')}, 0) AS rolling_std_7d,
 coalesce(quality_score_pct - {lag('quality_score_pct', 1, 'model', 'feedback_date')}, 0) AS day_over_day_change,
 coalesce({lag('quality_score_pct', 1, 'model', 'feedback_date')}, avg(quality_score_pct) OVER (PARTITION BY model)) AS quality_lag_1d,
 coalesce({lag('quality_score_pct', 7, 'model', 'feedback_date')}, avg(quality_score_pct) OVER (PARTITION BY model)) AS quality_lag_7d,
 CAST(isodow(feedback_date) - 1 AS INTEGER) AS day_of_week, CAST(month(feedback_date) AS INTEGER) AS "month",
 CASE model WHEN 'gpt-4o' THEN 0 WHEN 'claude-3-sonnet' THEN 1 WHEN 'gpt-3.5-turbo' THEN 2 END AS model_encoded
FROM quality""",
    "quality_feat": "SELECT * FROM quality_raw WHERE COLUMNS(*) IS NOT NULL",
    "limits": """
SELECT *, avg(quality_score_pct) OVER (PARTITION BY model) AS quality_mean,
 avg(quality_score_pct) OVER (PARTITION BY model) - 2 * stddev_samp(quality_score_pct) OVER (PARTITION BY model) AS stat_threshold
FROM quality_feat""",
    "flagged": "SELECT *, CASE WHEN quality_score_pct < stat_threshold THEN 1 ELSE 0 END AS stat_anomaly FROM limits",
    "qalerts": """
SELECT *, stat_anomaly AS is_anomaly,
 CASE WHEN stat_anomaly = 1 AND z_score < -2 THEN 'critical' WHEN stat_anomaly = 1 THEN 'warning' ELSE 'normal' END AS alert_severity
FROM flagged""",
    "spikes": "SELECT * FROM daily WHERE total_cost_usd > rolling_7d_avg_cost * 1.5e0 AND rolling_7d_avg_cost > 0",
    "summary": f"""
SELECT feedback_date AS alert_date, model, CAST(NULL AS VARCHAR) AS team, 'quality_drop' AS alert_type, alert_severity,
 format('Quality dropped to {{:.1f}}% (rolling avg: {{:.1f}}%)', {places('quality_score_pct', 1)},
  {places('rolling_7d_quality_score', 1)}) AS alert_message,
 quality_score_pct AS metric_value, rolling_7d_quality_score AS baseline_value
FROM qalerts WHERE is_anomaly = 1
UNION ALL
SELECT event_date, NULL, team, 'cost_spike', 'warning',
 format('Daily cost ${{:.3f}} exceeds 150% of 7-day avg ${{:.3f}}', {places('total_cost_usd', 3)},
  {places('rolling_7d_avg_cost', 3)}), total_cost_usd, rolling_7d_avg_cost
FROM spikes""",
    "baseline": f"""
SELECT team, {scaled(half_up(f"100*sum({units('total_cost_usd', 4)})", 'count(*)'), 6)} AS historical_avg_cost
FROM daily GROUP BY team""",
    "predicted_alerts": """
SELECT prediction_date AS alert_date, team, CAST(NULL AS VARCHAR) AS model, predicted_cost_usd AS metric_value,
 historical_avg_cost AS baseline_value, coalesce(predicted_cost_usd > historical_avg_cost * 1.2e0, false) AS is_alert,
 CASE WHEN predicted_cost_usd > historical_avg_cost * 1.5e0 THEN 'critical'
      WHEN predicted_cost_usd > historical_avg_cost * 1.2e0 THEN 'warning' ELSE 'normal' END AS severity,
 'cost_spike_predicted' AS alert_type, 'cost_forecasting_model' AS detected_by
FROM predictions LEFT JOIN baseline USING (team)""",
    "summary_ahead": """
SELECT * FROM predicted_alerts UNION ALL
SELECT feedback_date, NULL, model, quality_score_pct, 88e0, alert_severity <> 'normal', alert_severity,
 'quality_drop_detected', 'anomaly_detection_model' FROM qalerts""",
}

COST_KEPT = (
    ["event_date", "team", "total_cost_usd", "day_of_week", "day_of_month", '"month"', "week_of_year", "is_weekend"]
    + [f"cost_lag_{k}d" for k in LAGS]
    + ["total_calls", "rolling_7d_avg_cost", "team_encoded"]
)
COST_ROUNDED = ["rolling_mean_7d", "rolling_mean_14d", "rolling_std_7d"]
QUALITY_EXACT = ["quality_score_pct", "rolling_7d_quality_score", "day_of_week", '"month"', "model_encoded"]
QUALITY_ROUNDED = [
    "deviation_from_7d_avg",
    "z_score",
    "rolling_std_7d",
    "day_over_day_change",
    "quality_lag_1d",
    "quality_lag_7d",
]
QUALITY_ALL = QUALITY_EXACT + QUALITY_ROUNDED


def rounded(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"{places(c, digits)} AS {c}" for c in cols)


def standard(col: str) -> str:
    z = f"({col} - avg({col}) OVER ()) / CASE WHEN stddev_pop({col}) OVER () = 0 THEN 1 ELSE stddev_pop({col}) OVER () END"
    return f"{places(z, 6)} AS {col}"


def described(col: str) -> str:
    plain = col.strip('"')
    return f"""SELECT '{plain}' AS feature, count({col}) AS "count", {decimal_places(f'avg({col})', 3)} AS mean,
 {decimal_places(f'stddev_samp({col})', 3)} AS std, {decimal_places(f'min({col})', 3)} AS "min",
 {decimal_places(f'quantile_cont(CAST({col} AS DOUBLE), 0.25)', 3)} AS p25, {decimal_places(f'quantile_cont(CAST({col} AS DOUBLE), 0.5)', 3)} AS p50,
 {decimal_places(f'quantile_cont(CAST({col} AS DOUBLE), 0.75)', 3)} AS p75, {decimal_places(f'max({col})', 3)} AS "max" FROM quality_feat"""


def rule(name: str, cond: str, source: str) -> str:
    return f"""SELECT '{name}' AS rule, {big(f'count_if(coalesce({cond}, false))')} AS passed_records,
 {big(f'count(*) - count_if(coalesce({cond}, false))')} AS failed_records FROM {source}"""


CALL_RULES = {
    "valid_call_id": "call_id IS NOT NULL",
    "valid_tokens": "prompt_tokens > 0",
    "valid_latency": "latency_ms >= 0",
    "valid_team": "team IN ('product','data','marketing','ops','finance')",
    "valid_model": "model IN ('gpt-4o','gpt-3.5-turbo','claude-3-sonnet')",
}
CALL_COLUMNS = "call_id, team, feature, model, environment, prompt_tokens, completion_tokens, latency_ms, status, status_code, user_id"
IN_MODELS = "trim(model) IN ('gpt-4o','gpt-3.5-turbo','claude-3-sonnet')"
THUMBS = "CASE WHEN TRY_CAST(thumbs_up AS DOUBLE) IN (0, 1) THEN CAST(TRY_CAST(thumbs_up AS DOUBLE) AS INTEGER) END"
ERRORS = "count(*) AS test_rows, {mae} AS mae, {rmse} AS rmse, {mape} AS mape".format(
    mae=places("avg(abs(total_cost_usd - rolling_mean_7d))", 6),
    rmse=places("sqrt(avg((total_cost_usd - rolling_mean_7d) * (total_cost_usd - rolling_mean_7d)))", 6),
    mape=places("avg(abs((total_cost_usd - rolling_mean_7d) / (total_cost_usd + 1e-8))) * 100", 2),
)
ALERT_VIEW = f"""SELECT alert_date, team, model, alert_type, alert_severity, metric_value AS actual_value,
 baseline_value AS threshold_value, {places('metric_value - baseline_value', 4)} AS deviation FROM summary"""


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"


def of_model(model: str, value: str) -> str:
    return f"sum(CASE WHEN model = '{model}' THEN {value} END)"


COST_RATIO = ratio(of_model("gpt-4o", units("total_cost_usd", 4)), of_model("gpt-3.5-turbo", units("total_cost_usd", 4)))
CALL_RATIO = ratio(of_model("gpt-3.5-turbo", "total_calls"), of_model("gpt-4o", "total_calls"))
SPENT = sum_of("total_cost_usd", 4, 2)

QUERIES = {
    "decode_calls": """
SELECT CASE WHEN ok THEN call_id END AS call_id, CASE WHEN ok THEN "timestamp" END AS "timestamp", CASE WHEN ok THEN team END AS team,
 CASE WHEN ok THEN feature END AS feature, CASE WHEN ok THEN model END AS model, CASE WHEN ok THEN environment END AS environment,
 CASE WHEN ok THEN prompt_tokens END AS prompt_tokens, CASE WHEN ok THEN completion_tokens END AS completion_tokens,
 CASE WHEN ok THEN latency_ms END AS latency_ms, CASE WHEN ok THEN status END AS status,
 CASE WHEN ok THEN status_code END AS status_code, CASE WHEN ok THEN user_id END AS user_id,
 make_timestamp(CAST(prompt_tokens AS BIGINT) * 1000000) AS kafka_timestamp
FROM (SELECT *, latency_ms <> 900 AS ok FROM calls_dirty)""",
    "calls_unified": """
SELECT *, CASE WHEN environment = 'dev' THEN make_timestamp(CAST(prompt_tokens AS BIGINT) * 1000000) END AS kafka_timestamp
FROM calls WHERE environment = 'prod' OR latency_ms <> 900
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, make_timestamp(CAST(prompt_tokens AS BIGINT) * 1000000)
FROM calls WHERE environment = 'dev' AND latency_ms = 900""",
    "silver_api_calls": f"""
SELECT {CALL_COLUMNS}, event_timestamp, event_date, total_tokens, is_slow, is_error, {scaled('micros', 6)} AS cost_usd
FROM silver_dirty""",
    "silver_fine_prices": "SELECT call_id, model, CASE WHEN micros IS NOT NULL THEN CAST(micros AS DOUBLE) / 1e6 END AS cost_usd FROM silver_fine",
    "duplicate_prices": """
SELECT model, count(*) AS price_rows, count(DISTINCT CASE kind WHEN 0 THEN 'fine ' || CAST(p_size AS VARCHAR) WHEN 2 THEN 'none' ELSE 'old' END) AS distinct_prices
FROM fine_prices GROUP BY model HAVING count(*) > 1""",
    "silver_live_calls": f"""
SELECT {CALL_COLUMNS}, kafka_timestamp, event_timestamp, event_date, total_tokens, is_slow, is_error, {scaled('micros', 6)} AS cost_usd,
 TIMESTAMP '2026-02-03 04:05:06' AS silver_loaded_at FROM silver_live""",
    "daily_cost_loaded": "SELECT *, TIMESTAMP '2026-02-03 04:05:06' AS gold_loaded_at FROM daily",
    "dq_rule_counts": " UNION ALL ".join(
        rule(name, cond, "cleaned_dirty")
        for name, cond in {
            **CALL_RULES,
            "parsable_timestamp": "event_timestamp IS NOT NULL",
            "all_rules": " AND ".join(f"coalesce({c}, false)" for c in CALL_RULES.values()),
        }.items()
    ),
    "dq_feedback_rule_counts": " UNION ALL ".join(
        rule(name, cond, "feedback_dirty")
        for name, cond in {
            "valid_feedback_model": IN_MODELS,
            "valid_thumbs": f"{THUMBS} IN (0, 1)",
            "all_rules": f"{IN_MODELS} AND coalesce({THUMBS} IN (0, 1), false)",
        }.items()
    ),
    "dq_pricing_rule_counts": " UNION ALL ".join(
        rule(name, cond, "part")
        for name, cond in {
            "valid_pricing_model": "p_partkey % 4 <> 3",
            "readable_prices": "p_retailprice IS NOT NULL",
            "exact_prices": "p_retailprice IS NOT NULL",
            "all_rules": "p_partkey % 4 <> 3",
        }.items()
    ),
    "silver_quality_feedback": f"""
SELECT TRY_CAST("date" AS DATE) AS feedback_date, trim(model) AS model, {THUMBS} AS thumbs_up, {THUMBS} = 1 AS thumbs_up_bool
FROM feedback_dirty WHERE trim(model) IN ('gpt-4o','gpt-3.5-turbo','claude-3-sonnet') AND {THUMBS} IN (0, 1)""",
    "silver_model_pricing": """
SELECT CASE p_partkey % 4 WHEN 0 THEN 'gpt-4o' WHEN 1 THEN 'gpt-3.5-turbo' ELSE 'claude-3-sonnet' END AS model,
 CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS prompt_price_per_1k_tokens,
 CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 2 AS DOUBLE) AS completion_price_per_1k_tokens, p_brand AS provider
FROM part WHERE p_partkey % 4 <> 3""",
    "valid_email": """
SELECT c_custkey, email, coalesce(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'), false) AS is_valid
FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN lower(c_mktsegment) || '@example.com'
 WHEN 1 THEN c_mktsegment || ' @example.com' WHEN 2 THEN c_mktsegment ELSE NULL END AS email FROM customer)""",
    "daily_cost_by_team": "SELECT * FROM daily",
    "daily_cost_from_parts": "SELECT * FROM daily",
    "unique_users_by_month": """
SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, model, count(DISTINCT user_id) AS unique_users, true AS within_error
FROM silver GROUP BY ALL""",
    "refused_calls": "SELECT * FROM (SELECT call_id, team, model, prompt_tokens, latency_ms, user_id, CAST("
    + " + ".join(f"CASE WHEN coalesce({cond}, false) THEN 0 ELSE {1 << i} END" for i, cond in enumerate(CALL_RULES.values()))
    + f" + CASE WHEN event_timestamp IS NULL THEN {1 << len(CALL_RULES)} ELSE 0 END AS INTEGER) AS failed_rules FROM cleaned_dirty)"
    + f" WHERE failed_rules % {1 << len(CALL_RULES)} <> 0",
    "rolling_cost_calendar": f"""
SELECT event_date, team, total_cost_usd, {mean_of('total_cost_usd', 4,
    "OVER (PARTITION BY team ORDER BY event_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)")} AS rolling_7_calendar_days
FROM daily""",
    "model_performance_summary": "SELECT * FROM perf",
    "feature_cost_breakdown": "SELECT * FROM breakdown",
    "quality_score_daily": "SELECT * FROM quality",
    "team_cost_baseline": "SELECT * FROM baseline",
    "team_cost_stats": f"""
SELECT team, {mean_of('total_cost_usd', 4)} AS mean_cost_usd, {sum_of('total_cost_usd', 4, 4)} AS sum_cost_usd,
 max(total_cost_usd) AS max_cost_usd FROM daily GROUP BY team""",
    "model_quality_stats": f"""
SELECT model, {mean_of('quality_score_pct', 2)} AS mean_score, {places('stddev_samp(quality_score_pct)', 2)} AS std_score,
 min(quality_score_pct) AS min_score, max(quality_score_pct) AS max_score FROM quality GROUP BY model""",
    "quality_feature_summary": " UNION ALL ".join(described(c) for c in QUALITY_ALL),
    "dataset_overview": f"""
SELECT count(*) AS total_calls, {scaled(half_up('sum(micros)', '10000'), 2)} AS total_cost_usd, min(event_date) AS first_date,
 max(event_date) AS last_date, count(DISTINCT event_date) AS days_covered, count(DISTINCT team) AS teams,
 count(DISTINCT model) AS models, count(DISTINCT feature) AS features FROM silver""",
    "cost_history_overview": """
SELECT count(*) AS row_count, min(event_date) AS first_date, max(event_date) AS last_date,
 string_agg(DISTINCT team, ', ' ORDER BY team) AS names FROM daily""",
    "quality_history_overview": """
SELECT count(*) AS row_count, min(feedback_date) AS first_date, max(feedback_date) AS last_date,
 string_agg(DISTINCT model, ', ' ORDER BY model) AS names FROM quality""",
    "model_cost_ratio": f"""
SELECT 'gpt-4o' AS model, 'gpt-3.5-turbo' AS compared_with, {places(COST_RATIO, 4)} AS total_cost_ratio,
 {places(f'{COST_RATIO} * {CALL_RATIO}', 4)} AS cost_per_call_ratio FROM perf""",
    "cost_features": f"SELECT {', '.join(COST_KEPT)}, {rounded(COST_ROUNDED)} FROM cost_feat",
    "cost_features_leak_free": f"""
SELECT * EXCLUDE (total_calls, rolling_7d_avg_cost, before_calls, before_rolling), before_calls AS total_calls, before_rolling AS rolling_7d_avg_cost
FROM (SELECT {', '.join(COST_KEPT)}, {rounded(COST_ROUNDED)}, {lag('total_calls', 1)} AS before_calls, {lag('rolling_7d_avg_cost', 1)} AS before_rolling
 FROM cost_raw) WHERE cost_lag_30d IS NOT NULL""",
    "train_test_split": "SELECT split, count(*) AS row_count, min(event_date) AS first_date, max(event_date) AS last_date FROM split GROUP BY split",
    "team_last_profile": f"SELECT team, {rounded([f'cost_lag_{k}d' for k in LAGS] + COST_ROUNDED + ['total_calls', 'rolling_7d_avg_cost'])} FROM profile",
    "forecast_frame": f"""
SELECT team, prediction_date, prediction_horizon_days, {calendar('prediction_date')}, {TEAM_CODE},
 {rounded([f'cost_lag_{k}d' for k in LAGS] + COST_ROUNDED + ['total_calls', 'rolling_7d_avg_cost'])} FROM ahead""",
    "forecast_coverage": """
SELECT team, count(*) AS history_rows, (SELECT count(*) FROM cost_feat f WHERE f.team = d.team) AS feature_rows,
 (SELECT count(*) FROM cost_feat f WHERE f.team = d.team) > 0 AS has_forecast FROM daily d GROUP BY team""",
    "naive_forecast": "SELECT * FROM predictions",
    "forecast_shape": """
SELECT team, count(*) AS days_predicted, min(prediction_date) AS first_date, max(prediction_date) AS last_date,
 min(prediction_horizon_days) AS first_horizon, max(prediction_horizon_days) AS last_horizon, true AS none_negative
FROM ahead GROUP BY team""",
    "weekend_forecast": "SELECT event_date, team, CASE WHEN is_weekend = 1 THEN 1.5e0 ELSE 4e0 END AS predicted_cost_usd FROM cost_feat",
    "importance_total": "SELECT CAST(16 AS BIGINT) AS inputs, 1e0 AS importance FROM (SELECT 1 FROM cost_feat LIMIT 1)",
    "forest_flags": "SELECT count(*) AS scored, CAST(ceil(0.05 * (count(*) - 1)) AS BIGINT) AS flagged FROM quality_feat",
    "forest_planted": "SELECT min(feedback_date) AS feedback_date, model FROM quality_feat GROUP BY model",
    "naive_forecast_metrics": f"SELECT {ERRORS} FROM split WHERE split = 'test'",
    "prediction_summary": f"""
SELECT team, min(predicted_cost_usd) AS min_predicted, max(predicted_cost_usd) AS max_predicted,
 {scaled(half_up(f"sum({units('predicted_cost_usd', 6)})", '100 * count(*)'), 4)} AS avg_predicted, count(*) AS days_predicted
FROM predictions GROUP BY team""",
    "quality_features": f"SELECT feedback_date, model, total_feedback, {', '.join(QUALITY_EXACT)}, {rounded(QUALITY_ROUNDED)} FROM quality_feat",
    "scaled_quality_features": f"SELECT feedback_date, model, {', '.join(standard(c) for c in QUALITY_ALL)} FROM quality_feat",
    "scaled_quality_merged": f"SELECT feedback_date, model, {', '.join(standard(c) for c in QUALITY_ALL)} FROM quality_feat",
    "quality_limits_merged": f"""
SELECT feedback_date, model, quality_score_pct, {rounded(['quality_mean', 'stat_threshold'])}, stat_anomaly FROM flagged""",
    "quality_stat_anomalies": f"""
SELECT feedback_date, model, quality_score_pct, {rounded(['quality_mean', 'stat_threshold'])}, stat_anomaly FROM flagged""",
    "quality_alerts_stat": f"""
SELECT feedback_date, model, quality_score_pct, rolling_7d_quality_score, {rounded(['stat_threshold', 'deviation_from_7d_avg', 'z_score'])},
 0 AS if_anomaly, stat_anomaly, is_anomaly, CAST(NULL AS DOUBLE) AS if_anomaly_score, total_feedback, alert_severity FROM qalerts""",
    "anomaly_totals": f"""
SELECT model, alert_severity, count(*) AS day_count, {big('sum(is_anomaly)')} AS anomalies,
 {places('CAST(sum(is_anomaly) AS DOUBLE) * 100 / count(*)', 2)} AS anomaly_rate_pct
FROM qalerts GROUP BY GROUPING SETS ((), (model), (alert_severity))""",
    "recent_anomalies": f"""
SELECT feedback_date, model, quality_score_pct AS quality_score, rolling_7d_quality_score AS rolling_avg, {places('z_score', 2)} AS z_score, alert_severity
FROM (SELECT * FROM qalerts WHERE is_anomaly = 1 ORDER BY feedback_date DESC, z_score, model LIMIT 20)""",
    "cost_spikes": "SELECT * FROM spikes",
    "alert_summary": "SELECT * FROM summary",
    "alert_counts": "SELECT alert_type, alert_severity, count(*) AS total_alerts FROM summary GROUP BY alert_type, alert_severity",
    "alerts_view": ALERT_VIEW,
    "alerts_view_filtered": ALERT_VIEW + " WHERE alert_severity = 'warning' AND alert_type = 'cost_spike'",
    "alert_counters": """
SELECT count(*) AS total_alerts, CAST(count_if(alert_severity = 'critical') AS BIGINT) AS critical_alerts,
 CAST(count_if(alert_severity = 'warning') AS BIGINT) AS warning_alerts FROM summary""",
    "active_critical": "SELECT count(*) AS val FROM summary WHERE alert_severity = 'critical'",
    "critical_quality_alerts": "SELECT count(*) AS val FROM summary WHERE alert_severity = 'critical' AND alert_type = 'quality_drop'",
    "predicted_cost_alerts": "SELECT * FROM predicted_alerts",
    "alert_summary_forecast": "SELECT * FROM summary_ahead",
    "alert_counts_forecast": "SELECT alert_type, severity AS alert_severity, count(*) AS total_alerts FROM summary_ahead GROUP BY ALL",
    "project_summary": f"""
SELECT 'Total API calls processed' AS metric, CAST(count(*) AS DOUBLE) AS value FROM silver
UNION ALL SELECT 'Total cost tracked (USD)', {scaled(half_up('sum(micros)', '10000'), 2)} FROM silver
UNION ALL SELECT 'Days of data', CAST(count(DISTINCT event_date) AS DOUBLE) FROM silver
UNION ALL SELECT 'Cost spike alerts generated', CAST(count(*) AS DOUBLE) FROM summary_ahead WHERE alert_type = 'cost_spike_predicted' AND is_alert
UNION ALL SELECT 'Quality drop alerts generated', CAST(count(*) AS DOUBLE) FROM summary_ahead WHERE alert_type = 'quality_drop_detected' AND is_alert
UNION ALL SELECT 'Days of cost forecasted', CAST(count(DISTINCT prediction_date) AS DOUBLE) FROM predictions""",
    "kpi_total_spend": f"SELECT {SPENT} AS val FROM daily",
    "kpi_total_calls": f"SELECT {big('sum(total_calls)')} AS val FROM daily",
    "kpi_avg_cost": f"SELECT {mean_of('avg_cost_per_call', 6)} AS val FROM daily",
    "kpi_total_spend_teams": f"SELECT {SPENT} AS val FROM daily WHERE team IN ('data', 'ops')",
    "kpi_forecast_30d": f"SELECT {sum_of('predicted_cost_usd', 6, 2)} AS val FROM predictions WHERE prediction_horizon_days <= 30",
    "predicted_next_week": f"SELECT {sum_of('predicted_cost_usd', 6, 2)} AS val FROM predictions WHERE prediction_horizon_days <= 7",
    "forecast_series": "SELECT prediction_date, team, predicted_cost_usd FROM predictions",
    "cost_trend": "SELECT event_date, team, rolling_7d_avg_cost, total_cost_usd, total_calls FROM daily",
    "spend_by_model": f"SELECT model, {SPENT} AS total_spend FROM perf GROUP BY model",
    "top_features": f"""
SELECT feature, team, {SPENT} AS total_spend, {big('sum(total_calls)')} AS total_calls
FROM breakdown GROUP BY feature, team ORDER BY total_spend DESC, feature, team LIMIT 10""",
    "model_rollup": f"""
SELECT model, {mean_of('avg_latency_ms', 0)} AS avg_latency_ms, {mean_of('error_rate_pct', 2)} AS avg_error_rate_pct,
 {mean_of('slow_call_rate_pct', 2)} AS avg_slow_call_pct, {big('sum(total_calls)')} AS total_calls, {SPENT} AS total_cost_usd
FROM perf GROUP BY model""",
    "latency_trend": "SELECT event_date, model, avg_latency_ms FROM perf",
    "error_trend": "SELECT event_date, model, error_rate_pct FROM perf",
    "top_error_model": f"""
SELECT model, {percent('sum(error_count)', 'sum(total_calls)')} AS error_rate_pct FROM breakdown GROUP BY model
ORDER BY error_rate_pct DESC, model LIMIT 1""",
    "quality_trend": """
SELECT feedback_date, model, quality_score_pct, rolling_7d_quality_score,
 CASE WHEN rolling_7d_quality_score < 75 THEN 'critical' WHEN rolling_7d_quality_score < 85 THEN 'warning' ELSE 'normal' END AS band
FROM quality""",
    "latest_quality_by_model": """
SELECT model, feedback_date, quality_score_pct, rolling_7d_quality_score
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY feedback_date DESC) AS back FROM quality) WHERE back = 1""",
    "spend_this_month": f"SELECT {SPENT} AS val FROM daily WHERE event_date >= DATE '1998-08-01' AND event_date < DATE '1998-09-01'",
    "top_team_last_month": f"""
SELECT team, {SPENT} AS total_spend FROM daily WHERE event_date >= DATE '1998-07-01' AND event_date < DATE '1998-08-01'
GROUP BY team ORDER BY total_spend DESC, team LIMIT 1""",
}


def sql(name: str) -> str:
    """The query with the steps it needs, in the order of their definition."""
    needed: set[str] = set()
    todo = [QUERIES[name]]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for step in words & (set(STEPS) - needed):
            needed.add(step)
            todo.append(STEPS[step])
    steps = [f"{step} AS ({body})" for step, body in STEPS.items() if step in needed]
    return f"WITH {', '.join(steps)} {QUERIES[name]}" if steps else QUERIES[name]

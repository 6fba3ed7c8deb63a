"""The registered queries: each reads the given tables and returns a DataFrame.

Queries that follow from predictions or anomaly flags run on the naive
forecast and the control limits, which SQL can express; ``cost_forecast``,
``quality_alerts`` and their like run the learners themselves.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import cached_property, partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles  # noqa: E402
from callmeter import fixtures, session  # noqa: E402
from callmeter.functions.exact import round_places  # noqa: E402
from callmeter.functions.text import is_valid_email  # noqa: E402
from callmeter.operators import moments  # noqa: E402
from callmeter.operators.durable import cut_lineage  # noqa: E402
from callmeter.plans import alerts, anomaly, features, forecast, gold, serving, silver, stats  # noqa: E402
from callmeter.sources.readers import decode_calls  # noqa: E402

try:  # The subpackage and its pipeline may be absent; the other queries do without.
    import corpus_pipeline  # noqa: E402
    from callmeter.llm import registry as llm  # noqa: E402
except ModuleNotFoundError as missing:
    # So may be a library that only they need; of the rest of the package nothing may be missing.
    if missing.name.startswith("callmeter") and not missing.name.startswith("callmeter.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "1998-08-15"


class Tables:
    """The layers over one data directory, built on demand.

    Queries that need the daily costs several times take ``stored_daily``, a
    checkpoint, so that the calls are read once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.configure(spark)
        self.sf_dir = sf_dir

    def _of(self, fixture) -> DataFrame:
        return fixture(self.spark, self.sf_dir)

    def silver(self) -> DataFrame:
        return silver.api_calls(self._of(fixtures.calls), fixtures.prices(self.spark))

    def daily(self) -> DataFrame:
        return gold.daily_cost_by_team(self.silver())

    @cached_property
    def cube(self) -> DataFrame:
        return cut_lineage(gold.call_cube(self.silver()))

    @cached_property
    def stored_daily(self) -> DataFrame:
        return cut_lineage(self.daily())

    def performance(self) -> DataFrame:
        return gold.model_performance_summary(self.silver())

    def breakdown(self) -> DataFrame:
        return gold.feature_cost_breakdown(self.silver())

    def quality(self) -> DataFrame:
        return gold.quality_score_daily(silver.quality_feedback(self._of(fixtures.feedback)))

    def cost_features(self) -> DataFrame:
        return features.cost_features(self.daily())

    def quality_features(self) -> DataFrame:
        return features.quality_features(self.quality())

    def predictions(self) -> DataFrame:
        return forecast.naive_forecast(features.cost_features(self.stored_daily), self.stored_daily)

    def stat_alerts(self) -> DataFrame:
        return anomaly.quality_alerts(anomaly.control_limits(self.quality_features()))

    def summary(self) -> DataFrame:
        return alerts.alert_summary(self.stat_alerts(), self.daily())

    def summary_ahead(self) -> DataFrame:
        return alerts.alert_summary_forecast(self.predictions(), self.stored_daily, self.stat_alerts())


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Six places for derived statistics, whose last bits depend on the order of addition."""
    return df.withColumns({c: round_places(c, 6) for c in cols})


COST_ROUNDED = ("rolling_mean_7d", "rolling_mean_14d", "rolling_std_7d")
PROFILE_ROUNDED = (
    *(f"cost_lag_{k}d" for k in features.COST_LAGS),
    *COST_ROUNDED,
    "total_calls",
    "rolling_7d_avg_cost",
)
QUALITY_ROUNDED = (
    "deviation_from_7d_avg",
    "z_score",
    "rolling_std_7d",
    "day_over_day_change",
    "quality_lag_1d",
    "quality_lag_7d",
)


def _plain_time(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


def _calls_unified(t: Tables) -> DataFrame:
    calls = t._of(fixtures.calls)
    live = decode_calls(fixtures.messages(calls.filter(F.col("environment") == "dev")))
    return _plain_time(silver.unify_calls(calls.filter(F.col("environment") == "prod"), live), "kafka_timestamp")


def _silver_dirty(t: Tables) -> DataFrame:
    calls = silver.api_calls(t._of(fixtures.calls_dirty), fixtures.prices(t.spark))
    return _plain_time(calls, "event_timestamp")


LOADED_AT = "2026-02-03 04:05:06"


def _load_time() -> Column:
    return F.lit(LOADED_AT).cast("timestamp")


def _silver_live(t: Tables) -> DataFrame:
    """History and live calls in one silver table, with a load time."""
    calls = t._of(fixtures.calls)
    # Live calls reach silver as a stored table, decoded when they were ingested.
    live = cut_lineage(decode_calls(fixtures.messages(calls.filter(F.col("environment") == "dev"))))
    history = calls.filter(F.col("environment") == "prod")
    found = silver.api_calls(history, fixtures.prices(t.spark), live, _load_time())
    for col in ("kafka_timestamp", "event_timestamp", "silver_loaded_at"):
        found = _plain_time(found, col)
    return found


def _silver_fine_prices(t: Tables) -> DataFrame:
    """Calls priced from a list with twins, unreadable rows and more than eight places."""
    cleaned = silver.clean_calls(t._of(fixtures.calls))
    return silver.price_calls(cleaned, t._of(fixtures.prices_dirty)).select("call_id", "model", "cost_usd")


def _daily_from_parts(t: Tables) -> DataFrame:
    """Daily costs from the partial cubes of three batches, into which the calls are dealt by their users."""
    calls = t.silver()
    batch = F.pmod(F.crc32("user_id"), F.lit(3))
    parts = [gold.call_cube(calls.filter(batch == k)) for k in range(3)]
    return gold.daily_cost_by_team(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _users_by_month(t: Tables) -> DataFrame:
    """Distinct users per month and model, and whether the merged sketches of days and teams come within 5 % of them."""
    calls = t.silver()
    month = F.date_trunc("month", "event_date").cast("date").alias("month")
    about = gold.users_over(cut_lineage(gold.user_sketches(calls)), month, "model")
    exact = calls.groupBy(month, "model").agg(F.count_distinct("user_id").alias("unique_users"))
    near = F.abs(F.col("approximate_users") - F.col("unique_users")) <= 0.05 * F.col("unique_users") + 1
    return exact.join(about, ["month", "model"]).select("month", "model", "unique_users", near.alias("within_error"))


def _refused_calls(t: Tables) -> DataFrame:
    found = silver.refused_calls(t._of(fixtures.calls_dirty))
    return found.select("call_id", "team", "model", "prompt_tokens", "latency_ms", "user_id", "failed_rules")


def _split(t: Tables) -> DataFrame:
    return (
        features.label_split(t.cost_features())
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("event_date").alias("first_date"),
            F.max("event_date").alias("last_date"),
        )
    )


def _forecast_frame(t: Tables) -> DataFrame:
    return _rounded(features.forecast_frame(features.cost_features(t.stored_daily), t.stored_daily), *PROFILE_ROUNDED)


def _cost_features(t: Tables, leak_free: bool = False) -> DataFrame:
    inputs = features.cost_features(t.daily(), leak_free)
    return _rounded(inputs, *COST_ROUNDED).select("event_date", "team", "total_cost_usd", *features.COST_FEATURES)


def _quality_features(t: Tables) -> DataFrame:
    return _rounded(t.quality_features(), *QUALITY_ROUNDED).select(
        "feedback_date", "model", "total_feedback", *features.QUALITY_FEATURES
    )


def _scaled(t: Tables) -> DataFrame:
    scaled = features.standardise(t.quality_features(), features.QUALITY_FEATURES)
    return _rounded(scaled, *features.QUALITY_FEATURES).select("feedback_date", "model", *features.QUALITY_FEATURES)


def _in_batches(features_: DataFrame) -> list[DataFrame]:
    """Three batches of days, dealt by the day of the month."""
    batch = F.dayofmonth("feedback_date") % 3
    return [features_.filter(batch == k) for k in range(3)]


def _limits_merged(t: Tables) -> DataFrame:
    """The control limits from moments that each batch of days has left."""
    days = cut_lineage(t.quality_features())
    parts = [anomaly.quality_moments(part) for part in _in_batches(days)]
    merged = moments.merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]), ("quality_score_pct",), "model")
    return _rounded(anomaly.limits_from(merged, days), "quality_mean", "stat_threshold").select(
        "feedback_date", "model", "quality_score_pct", "quality_mean", "stat_threshold", "stat_anomaly"
    )


def _scaled_merged(t: Tables) -> DataFrame:
    days = cut_lineage(t.quality_features())
    parts = [moments.partial_moments(part, features.QUALITY_FEATURES) for part in _in_batches(days)]
    merged = moments.merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]), features.QUALITY_FEATURES)
    scaled = features.scaled_by(days, merged, features.QUALITY_FEATURES)
    return _rounded(scaled, *features.QUALITY_FEATURES).select("feedback_date", "model", *features.QUALITY_FEATURES)


def _limits(t: Tables) -> DataFrame:
    limited = anomaly.control_limits(t.quality_features())
    return _rounded(limited, "quality_mean", "stat_threshold").select(
        "feedback_date", "model", "quality_score_pct", "quality_mean", "stat_threshold", "stat_anomaly"
    )


def _project_summary(t: Tables) -> DataFrame:
    t.stored_daily = cut_lineage(gold.daily_cost_by_team(t.cube))
    predictions = cut_lineage(t.predictions())
    ahead = alerts.alert_summary_forecast(predictions, t.stored_daily, t.stat_alerts())
    return alerts.project_summary(t.cube, ahead, predictions)


def _valid_email(t: Tables) -> DataFrame:
    return t._of(fixtures.emails).withColumn("is_valid", is_valid_email("email"))


_TRAINED: dict[tuple, tuple[forecast.Forecaster, DataFrame]] = {}


def _forecaster(t: Tables) -> tuple[forecast.Forecaster, DataFrame]:
    """A model trained on the daily costs, and the features it was trained on; once for all queries of a session on the same tables."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, tuple(forecast.SETTINGS.items()))
    if key not in _TRAINED:
        inputs = cut_lineage(features.cost_features(t.stored_daily))
        _TRAINED[key] = forecast.train(inputs), inputs
    return _TRAINED[key]


def _cost_forecast(t: Tables) -> DataFrame:
    fitted, inputs = _forecaster(t)
    return forecast.cost_forecast(fitted.model, inputs, t.stored_daily)


def _batch_score(t: Tables) -> DataFrame:
    fitted, inputs = _forecaster(t)
    return forecast.predict(fitted.model, inputs).select("event_date", "team", "total_cost_usd", "predicted_cost_usd")


WEEKDAY_COST, WEEKEND_COST = 4.0, 1.5


def _forecast_shape(t: Tables) -> DataFrame:
    """Per team: days forecast, their span and horizon, and whether all costs are at least 0."""
    return (
        _cost_forecast(t)
        .groupBy("team")
        .agg(
            F.count(F.lit(1)).alias("days_predicted"),
            F.min("prediction_date").alias("first_date"),
            F.max("prediction_date").alias("last_date"),
            F.min("prediction_horizon_days").alias("first_horizon"),
            F.max("prediction_horizon_days").alias("last_horizon"),
            F.bool_and(F.col("predicted_cost_usd") >= 0).alias("none_negative"),
        )
    )


def _weekend_forecast(t: Tables) -> DataFrame:
    """Predictions for costs that follow from the weekend flag alone, to four places: 300 steps leave a millionth of the way."""
    inputs = features.cost_features(t.stored_daily)
    cost = F.when(F.col("is_weekend") == 1, WEEKEND_COST).otherwise(WEEKDAY_COST)
    fitted = forecast.train(inputs.withColumn("total_cost_usd", cost))
    scored = forecast.predict(fitted.model, inputs)
    return scored.select("event_date", "team", round_places("predicted_cost_usd", 4).alias("predicted_cost_usd"))


def _importance_total(t: Tables) -> DataFrame:
    fitted, _ = _forecaster(t)
    return forecast.feature_importance(fitted, t.spark).agg(
        F.count(F.lit(1)).alias("inputs"), round_places(F.sum("importance"), 6).alias("importance")
    )


def _planted(t: Tables) -> DataFrame:
    """Quality features in which the first day of each model is far below all others."""
    found = t.quality_features()
    first = F.col("feedback_date") == F.min("feedback_date").over(Window.partitionBy("model"))
    names = ("quality_score_pct", "z_score", "deviation_from_7d_avg", "day_over_day_change")
    return found.withColumns({c: F.when(first, -500.0).otherwise(F.col(c)) for c in names}).withColumn("planted", first)


def _forest_planted(t: Tables) -> DataFrame:
    """Planted days that the forest flags."""
    scored = anomaly.score_with_forest(_planted(t), features.QUALITY_FEATURES, ("feedback_date", "model"))
    return scored.filter(F.col("planted") & (F.col("if_anomaly") == 1)).select("feedback_date", "model")


def _forest_flags(t: Tables) -> DataFrame:
    """Rows, and how many of them lie below the 5 % quantile of their scores."""
    return _forest_scores(t).agg(F.count(F.lit(1)).alias("scored"), F.sum("if_anomaly").alias("flagged"))


def _forest_alerts(t: Tables) -> DataFrame:
    return anomaly.detect_quality_anomalies(t.quality_features())


def _forest_scores(t: Tables) -> DataFrame:
    scored = anomaly.score_with_forest(t.quality_features(), features.QUALITY_FEATURES, ("feedback_date", "model"))
    return scored.select("feedback_date", "model", "quality_score_pct", "if_anomaly_score", "if_anomaly")


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # Bronze and silver
    "decode_calls": lambda t: _plain_time(
        decode_calls(fixtures.messages(t._of(fixtures.calls_dirty))), "kafka_timestamp"
    ),
    "calls_unified": _calls_unified,
    "silver_api_calls": _silver_dirty,
    "silver_live_calls": _silver_live,
    "silver_fine_prices": _silver_fine_prices,
    "duplicate_prices": lambda t: silver.duplicate_prices(t._of(fixtures.prices_dirty)),
    "silver_quality_feedback": lambda t: silver.quality_feedback(t._of(fixtures.feedback_dirty)),
    "silver_model_pricing": lambda t: silver.model_pricing(t._of(fixtures.raw_prices)),
    "refused_calls": _refused_calls,
    "dq_rule_counts": lambda t: silver.call_rule_counts(t._of(fixtures.calls_dirty)),
    "dq_feedback_rule_counts": lambda t: silver.feedback_rule_counts(t._of(fixtures.feedback_dirty)),
    "dq_pricing_rule_counts": lambda t: silver.pricing_rule_counts(t._of(fixtures.raw_prices)),
    "valid_email": _valid_email,
    # Gold
    "daily_cost_by_team": lambda t: t.daily(),
    "daily_cost_loaded": lambda t: _plain_time(
        gold.daily_cost_by_team(t.silver(), _load_time()), "gold_loaded_at"
    ),
    "daily_cost_from_parts": _daily_from_parts,
    "unique_users_by_month": _users_by_month,
    "rolling_cost_calendar": lambda t: gold.rolling_cost_calendar(t.daily()),
    "model_performance_summary": lambda t: t.performance(),
    "feature_cost_breakdown": lambda t: t.breakdown(),
    "quality_score_daily": lambda t: t.quality(),
    # Statistics
    "team_cost_baseline": lambda t: stats.team_cost_baseline(t.daily()),
    "team_cost_stats": lambda t: stats.team_cost_stats(t.daily()),
    "model_quality_stats": lambda t: stats.model_quality_stats(t.quality()),
    "quality_feature_summary": lambda t: stats.describe(t.quality_features(), features.QUALITY_FEATURES),
    "dataset_overview": lambda t: stats.dataset_overview(t.silver()),
    "cost_history_overview": lambda t: stats.series_overview(t.daily(), "event_date", "team"),
    "quality_history_overview": lambda t: stats.series_overview(t.quality(), "feedback_date", "model"),
    "model_cost_ratio": lambda t: stats.model_cost_ratio(t.performance()),
    # Features and forecasts
    "cost_features": _cost_features,
    "cost_features_leak_free": partial(_cost_features, leak_free=True),
    "train_test_split": _split,
    "team_last_profile": lambda t: _rounded(features.team_last_profile(t.cost_features()), *PROFILE_ROUNDED),
    "forecast_frame": _forecast_frame,
    "forecast_coverage": lambda t: features.forecast_coverage(
        features.cost_features(t.stored_daily), t.stored_daily
    ),
    "naive_forecast": lambda t: t.predictions(),
    "naive_forecast_metrics": lambda t: forecast.naive_metrics(t.cost_features()),
    "prediction_summary": lambda t: stats.prediction_summary(t.predictions()),
    "cost_forecast": _cost_forecast,
    "forecast_metrics": lambda t: _forecaster(t)[0].metrics,
    "feature_importance": lambda t: forecast.feature_importance(_forecaster(t)[0], t.spark),
    "forecast_shape": _forecast_shape,
    "weekend_forecast": _weekend_forecast,
    "importance_total": _importance_total,
    "batch_score": _batch_score,
    # Anomalies
    "quality_features": _quality_features,
    "scaled_quality_features": _scaled,
    "quality_stat_anomalies": _limits,
    "quality_limits_merged": _limits_merged,
    "scaled_quality_merged": _scaled_merged,
    "quality_alerts_stat": lambda t: _rounded(t.stat_alerts(), "stat_threshold", "deviation_from_7d_avg", "z_score"),
    "anomaly_totals": lambda t: anomaly.anomaly_totals(t.stat_alerts()),
    "recent_anomalies": lambda t: alerts.recent_anomalies(t.stat_alerts()),
    "quality_forest_scores": _forest_scores,
    "quality_alerts": _forest_alerts,
    "forest_flags": _forest_flags,
    "forest_planted": _forest_planted,
    "cost_forest_scores": lambda t: anomaly.detect_cost_anomalies(features.spike_features(t.daily())),
    # Alerts
    "cost_spikes": lambda t: alerts.cost_spikes(t.daily()),
    "alert_summary": lambda t: t.summary(),
    "alert_counts": lambda t: alerts.alert_counts(t.summary()),
    "alerts_view": lambda t: alerts.alerts_view(t.summary()),
    "alerts_view_filtered": lambda t: alerts.alerts_view(t.summary(), "warning", "cost_spike"),
    "alert_counters": lambda t: alerts.alert_counters(t.summary()),
    "active_critical": lambda t: serving.active_critical(t.summary()),
    "critical_quality_alerts": lambda t: serving.critical_quality_alerts(t.summary()),
    "predicted_cost_alerts": lambda t: alerts.predicted_cost_alerts(t.predictions(), t.stored_daily),
    "alert_summary_forecast": lambda t: t.summary_ahead(),
    "alert_counts_forecast": lambda t: alerts.alert_counts(t.summary_ahead()),
    "project_summary": _project_summary,
    # Dashboards
    "kpi_total_spend": lambda t: serving.kpi_total_spend(t.daily()),
    "kpi_total_spend_teams": lambda t: serving.kpi_total_spend(t.daily(), ["data", "ops"]),
    "kpi_total_calls": lambda t: serving.kpi_total_calls(t.daily()),
    "kpi_avg_cost": lambda t: serving.kpi_avg_cost(t.daily()),
    "kpi_forecast_30d": lambda t: serving.kpi_forecast_30d(t.predictions()),
    "predicted_next_week": lambda t: serving.predicted_next_week(t.predictions()),
    "forecast_series": lambda t: serving.forecast_series(t.predictions()),
    "cost_trend": lambda t: serving.cost_trend(t.daily()),
    "spend_by_model": lambda t: serving.spend_by_model(t.performance()),
    "top_features": lambda t: serving.top_features(t.breakdown()),
    "spend_this_month": lambda t: serving.spend_this_month(t.daily(), F.lit(AS_OF).cast("date")),
    "top_team_last_month": lambda t: serving.top_team_last_month(t.daily(), F.lit(AS_OF).cast("date")),
    "model_rollup": lambda t: serving.model_rollup(t.performance()),
    "latency_trend": lambda t: serving.latency_trend(t.performance()),
    "error_trend": lambda t: serving.error_trend(t.performance()),
    "top_error_model": lambda t: serving.top_error_model(t.breakdown()),
    "quality_trend": lambda t: serving.quality_trend(t.quality()),
    "latest_quality_by_model": lambda t: serving.latest_quality_by_model(t.quality()),
}


def _run(build: Callable[[Tables], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(Tables(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Daily cost per team with its rolling mean, on the smallest data set."""
    return queries()["daily_cost_by_team"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator: (spark, directory of the tables) to DataFrame."""
    own = {name: partial(_run, build) for name, build in _QUERIES.items()}
    return own if llm is None else own | {"pipeline": corpus_pipeline.run} | llm.QUERIES


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB's SQL, for every query that SQL can express."""
    own = {name: oracles.sql(name) for name in oracles.QUERIES}
    return own if llm is None else own | llm.ORACLE_SQL

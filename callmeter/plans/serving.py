"""Questions of the finance, engineering and quality dashboards over the gold tables.

Each function takes the gold tables it reads and, where the dashboard offers
it, a choice of teams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.functions.columns import only_teams
from callmeter.functions.exact import mean_places, percent, sum_places
from callmeter.plans.alerts import QUALITY_DROP
from callmeter.schemas import CALL_COST_PLACES, DAILY_COST_PLACES, PERCENT_PLACES

Teams = Sequence[str] | None

# Limits of the quality chart.
QUALITY_WARNING = 85
QUALITY_CRITICAL = 75


def _spend(alias: str = "total_spend") -> Column:
    return sum_places("total_cost_usd", DAILY_COST_PLACES, 2).alias(alias)


def _predicted(predictions: DataFrame, days: int, teams: Teams) -> DataFrame:
    chosen = only_teams(predictions, teams).filter(F.col("prediction_horizon_days") <= days)
    return chosen.agg(sum_places("predicted_cost_usd", CALL_COST_PLACES, 2).alias("val"))


# Finance


def kpi_total_spend(daily_cost: DataFrame, teams: Teams = None) -> DataFrame:
    return only_teams(daily_cost, teams).agg(_spend("val"))


def kpi_total_calls(daily_cost: DataFrame, teams: Teams = None) -> DataFrame:
    return only_teams(daily_cost, teams).agg(F.sum("total_calls").alias("val"))


def kpi_avg_cost(daily_cost: DataFrame, teams: Teams = None) -> DataFrame:
    """Mean of the daily means, not weighted by calls."""
    return only_teams(daily_cost, teams).agg(mean_places("avg_cost_per_call", CALL_COST_PLACES).alias("val"))


def kpi_forecast_30d(predictions: DataFrame, teams: Teams = None) -> DataFrame:
    return _predicted(predictions, 30, teams)


def predicted_next_week(predictions: DataFrame, teams: Teams = None) -> DataFrame:
    return _predicted(predictions, 7, teams)


def cost_trend(daily_cost: DataFrame, teams: Teams = None) -> DataFrame:
    return (
        only_teams(daily_cost, teams)
        .select("event_date", "team", "rolling_7d_avg_cost", "total_cost_usd", "total_calls")
        .orderBy("event_date", "team")
    )


def spend_by_model(performance: DataFrame) -> DataFrame:
    return performance.groupBy("model").agg(_spend()).orderBy(F.desc("total_spend"), "model")


def forecast_series(predictions: DataFrame, teams: Teams = None) -> DataFrame:
    return (
        only_teams(predictions, teams)
        .select("prediction_date", "team", "predicted_cost_usd")
        .orderBy("prediction_date", "team")
    )


def top_features(breakdown: DataFrame, teams: Teams = None, limit: int = 10) -> DataFrame:
    """The features that cost most, per team."""
    return (
        only_teams(breakdown, teams)
        .groupBy("feature", "team")
        .agg(_spend(), F.sum("total_calls").alias("total_calls"))
        .orderBy(F.desc("total_spend"), "feature", "team")
        .limit(limit)
    )


def spend_this_month(daily_cost: DataFrame, as_of: Column | None = None, teams: Teams = None) -> DataFrame:
    """Spend of the calendar month of ``as_of``, today by default."""
    start = F.trunc(as_of if as_of is not None else F.current_date(), "month")
    day = F.col("event_date")
    month = only_teams(daily_cost, teams).filter((day >= start) & (day < F.add_months(start, 1)))
    return month.agg(_spend("val"))


def top_team_last_month(daily_cost: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The team that spent most in the month before that of ``as_of``."""
    end = F.trunc(as_of if as_of is not None else F.current_date(), "month")
    day = F.col("event_date")
    return (
        daily_cost.filter((day >= F.add_months(end, -1)) & (day < end))
        .groupBy("team")
        .agg(_spend())
        .orderBy(F.desc("total_spend"), "team")
        .limit(1)
    )


# Engineering


def model_rollup(performance: DataFrame) -> DataFrame:
    """Means of the daily figures per model, with total calls and cost."""
    return performance.groupBy("model").agg(
        mean_places("avg_latency_ms", 0).alias("avg_latency_ms"),
        mean_places("error_rate_pct", PERCENT_PLACES).alias("avg_error_rate_pct"),
        mean_places("slow_call_rate_pct", PERCENT_PLACES).alias("avg_slow_call_pct"),
        F.sum("total_calls").alias("total_calls"),
        _spend("total_cost_usd"),
    )


def latency_trend(performance: DataFrame) -> DataFrame:
    return performance.select("event_date", "model", F.round("avg_latency_ms", 0).alias("avg_latency_ms")).orderBy(
        "event_date", "model"
    )


def error_trend(performance: DataFrame) -> DataFrame:
    return performance.select("event_date", "model", F.round("error_rate_pct", 2).alias("error_rate_pct")).orderBy(
        "event_date", "model"
    )


def top_error_model(breakdown: DataFrame) -> DataFrame:
    """The model with the highest share of failed calls over all history."""
    rate = percent(F.sum("error_count"), F.sum("total_calls"))
    return (
        breakdown.groupBy("model")
        .agg(rate.alias("error_rate_pct"))
        .orderBy(F.desc("error_rate_pct"), "model")
        .limit(1)
    )


# Quality


def quality_trend(quality: DataFrame) -> DataFrame:
    """Scores over time, and the band of the chart that the rolling score lies in."""
    rolling = F.col("rolling_7d_quality_score")
    band = (
        F.when(rolling < QUALITY_CRITICAL, F.lit("critical"))
        .when(rolling < QUALITY_WARNING, F.lit("warning"))
        .otherwise(F.lit("normal"))
    )
    return quality.select(
        "feedback_date", "model", "quality_score_pct", "rolling_7d_quality_score", band.alias("band")
    ).orderBy("feedback_date", "model")


def latest_quality_by_model(quality: DataFrame) -> DataFrame:
    """The last known value of each column per model."""

    def last(col: str) -> Column:
        return F.max_by(col, F.when(F.col(col).isNotNull(), F.col("feedback_date"))).alias(col)

    return quality.groupBy("model").agg(
        F.max("feedback_date").alias("feedback_date"),
        last("quality_score_pct"),
        last("rolling_7d_quality_score"),
    )


# Alerts


def active_critical(summary: DataFrame) -> DataFrame:
    """Number of critical alerts of any type."""
    return summary.agg(F.count_if(F.col("alert_severity") == "critical").alias("val"))


def critical_quality_alerts(summary: DataFrame) -> DataFrame:
    hit = (F.col("alert_type") == QUALITY_DROP) & (F.col("alert_severity") == "critical")
    return summary.agg(F.count_if(hit).alias("val"))

"""Alert tables: quality drops, cost spikes, predicted spikes, and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.functions.columns import stamped
from callmeter.functions.exact import drop_places, from_units, round_places
from callmeter.plans.gold import roll_up
from callmeter.plans.stats import team_cost_baseline
from callmeter.schemas import CALL_COST_PLACES

# Thresholds, the quality that a score is compared with, and the
# names and messages that readers of the alert tables look for.
SPIKE_FACTOR = 1.5
PREDICTED_WARNING = 1.2
PREDICTED_CRITICAL = 1.5
EXPECTED_QUALITY = 88.0
QUALITY_DROP = "quality_drop"
COST_SPIKE = "cost_spike"
SPIKE_PREDICTED = "cost_spike_predicted"
DROP_DETECTED = "quality_drop_detected"
BY_FORECAST = "cost_forecasting_model"
BY_DETECTOR = "anomaly_detection_model"
QUALITY_MESSAGE = "Quality dropped to %.1f%% (rolling avg: %.1f%%)"
SPIKE_MESSAGE = "Daily cost $%.3f exceeds 150%% of 7-day avg $%.3f"
FIGURES = (
    "Total API calls processed",
    "Total cost tracked (USD)",
    "Days of data",
    "Cost spike alerts generated",
    "Quality drop alerts generated",
    "Days of cost forecasted",
)

ALL = "All"


def _message(text: str, value: Column, baseline: Column, places: int) -> Column:
    """A template filled with a value and its baseline, in fixed decimals."""
    shown = [round_places(number, places) for number in (value, baseline)]
    return F.format_string(text, *shown).alias("alert_message")


def cost_spikes(daily_cost: DataFrame) -> DataFrame:
    """Days that cost more than half as much again as the rolling mean, which includes the day."""
    mean = F.col("rolling_7d_avg_cost")
    return daily_cost.filter((F.col("total_cost_usd") > mean * SPIKE_FACTOR) & (mean > 0))


def alert_summary(quality_alerts: DataFrame, daily_cost: DataFrame) -> DataFrame:
    """Quality drops and cost spikes in one shape, with a message each."""
    none = F.lit(None).cast("string")
    score, rolling = F.col("quality_score_pct"), F.col("rolling_7d_quality_score")
    drops = quality_alerts.filter(F.col("is_anomaly") == 1).select(
        F.col("feedback_date").alias("alert_date"),
        "model",
        none.alias("team"),
        F.lit(QUALITY_DROP).alias("alert_type"),
        "alert_severity",
        _message(QUALITY_MESSAGE, score, rolling, 1),
        score.alias("metric_value"),
        rolling.alias("baseline_value"),
    )
    cost, mean = F.col("total_cost_usd"), F.col("rolling_7d_avg_cost")
    spikes = cost_spikes(daily_cost).select(
        F.col("event_date").alias("alert_date"),
        none.alias("model"),
        "team",
        F.lit(COST_SPIKE).alias("alert_type"),
        F.lit("warning").alias("alert_severity"),
        _message(SPIKE_MESSAGE, cost, mean, 3),
        cost.alias("metric_value"),
        mean.alias("baseline_value"),
    )
    return drops.unionByName(spikes)


def predicted_cost_alerts(predictions: DataFrame, daily_cost: DataFrame) -> DataFrame:
    """Each prediction against the team's mean; a team without history counts as normal.

    No join hint: Spark broadcasts the means if they turn out small, and joins
    by shuffle if not.
    """
    predicted, mean = F.col("predicted_cost_usd"), F.col("historical_avg_cost")
    level = (
        F.when(predicted > mean * PREDICTED_CRITICAL, F.lit("critical"))
        .when(predicted > mean * PREDICTED_WARNING, F.lit("warning"))
        .otherwise(F.lit("normal"))
    )
    return predictions.join(team_cost_baseline(daily_cost), "team", "left").select(
        F.col("prediction_date").alias("alert_date"),
        "team",
        F.lit(None).cast("string").alias("model"),
        predicted.alias("metric_value"),
        mean.alias("baseline_value"),
        F.coalesce(predicted > mean * PREDICTED_WARNING, F.lit(False)).alias("is_alert"),
        level.alias("severity"),
        F.lit(SPIKE_PREDICTED).alias("alert_type"),
        F.lit(BY_FORECAST).alias("detected_by"),
    )


def alert_summary_forecast(
    predictions: DataFrame,
    daily_cost: DataFrame,
    quality_alerts: DataFrame,
    flag_every_day: bool = False,
    created_at: Column | None = None,
) -> DataFrame:
    """Predicted cost and daily quality in one shape.

    A normal quality day is no alert, unless ``flag_every_day`` marks every
    row of the quality table as one.
    """
    level = F.col("alert_severity")
    drops = quality_alerts.select(
        F.col("feedback_date").alias("alert_date"),
        F.lit(None).cast("string").alias("team"),
        "model",
        F.col("quality_score_pct").alias("metric_value"),
        F.lit(EXPECTED_QUALITY).alias("baseline_value"),
        (F.lit(True) if flag_every_day else level != "normal").alias("is_alert"),
        level.alias("severity"),
        F.lit(DROP_DETECTED).alias("alert_type"),
        F.lit(BY_DETECTOR).alias("detected_by"),
    )
    return stamped(predicted_cost_alerts(predictions, daily_cost).unionByName(drops), "created_at", created_at)


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Alerts by type and severity, most frequent first, of either summary."""
    level = "alert_severity" if "alert_severity" in alerts.columns else "severity"
    return (
        alerts.groupBy("alert_type", F.col(level).alias("alert_severity"))
        .agg(F.count(F.lit(1)).alias("total_alerts"))
        .orderBy(F.desc("total_alerts"), "alert_type", "alert_severity")
    )


def project_summary(source: DataFrame, alerts: DataFrame, predictions: DataFrame) -> DataFrame:
    """Six figures over the whole project, as (metric, value).

    ``source`` is the silver calls or their cube, ``alerts`` the forecast
    summary. Each input is read once.
    """
    cube = roll_up(source, "event_date", "team", "feature", "model")
    total = from_units(drop_places(F.sum("cost_micros"), CALL_COST_PLACES, 2), 2)
    calls = cube.agg(
        F.sum("calls").cast("double").alias(FIGURES[0]),
        total.alias(FIGURES[1]),
        F.count_distinct("event_date").cast("double").alias(FIGURES[2]),
    )

    def raised(kind: str) -> Column:
        return F.count_if((F.col("alert_type") == kind) & F.col("is_alert")).cast("double")

    counted = alerts.agg(
        raised(SPIKE_PREDICTED).alias(FIGURES[3]),
        raised(DROP_DETECTED).alias(FIGURES[4]),
    )
    ahead = predictions.agg(
        F.count_distinct("prediction_date").cast("double").alias(FIGURES[5])
    )
    tall = [part.unpivot([], part.columns, "metric", "value") for part in (calls, counted, ahead)]
    return tall[0].unionByName(tall[1]).unionByName(tall[2])


def alerts_view(summary: DataFrame, severity: str = ALL, alert_type: str = ALL) -> DataFrame:
    """The alert list with each value's distance from its threshold, newest first."""
    view = summary.select(
        "alert_date",
        "team",
        "model",
        "alert_type",
        "alert_severity",
        F.col("metric_value").alias("actual_value"),
        F.col("baseline_value").alias("threshold_value"),
        round_places(F.col("metric_value") - F.col("baseline_value"), 4).alias("deviation"),
    )
    if severity != ALL:
        view = view.filter(F.col("alert_severity") == severity)
    if alert_type != ALL:
        view = view.filter(F.col("alert_type") == alert_type)
    return view.orderBy(F.desc("alert_date"), "alert_type", "team", "model")


def alert_counters(summary: DataFrame) -> DataFrame:
    level = F.col("alert_severity")
    return summary.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(level == "critical").alias("critical_alerts"),
        F.count_if(level == "warning").alias("warning_alerts"),
    )


def recent_anomalies(quality_alerts: DataFrame, limit: int = 20) -> DataFrame:
    """The newest anomalies, of one day the lowest z-score first."""
    return (
        quality_alerts.filter(F.col("is_anomaly") == 1)
        .orderBy(F.desc("feedback_date"), "z_score", "model")
        .limit(limit)
        .select(
            "feedback_date",
            "model",
            round_places("quality_score_pct", 2).alias("quality_score"),
            round_places("rolling_7d_quality_score", 2).alias("rolling_avg"),
            round_places("z_score", 2).alias("z_score"),
            "alert_severity",
        )
    )

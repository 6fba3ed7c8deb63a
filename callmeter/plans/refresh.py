"""Recompute the stored silver and gold tables of a lake."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, Observation
from pyspark.sql import functions as F

from callmeter.operators.together import run_together
from callmeter.plans import alerts, anomaly, features, forecast, gold, silver, upkeep
from callmeter.sources.lake import Lake, on_dates


def refresh_silver(lake: Lake, by_day: bool = False) -> dict[str, dict[str, int]]:
    """Store the silver tables; returns records and failures per rule of each.

    The calls are written by the tasks that read them, with no shuffle: every
    gold table reads all days anyway. ``by_day`` shuffles them into one folder
    per day instead, for lakes whose readers pick days and whose days are
    large. Live calls are optional. The one write splits the calls into those
    kept and ``api_calls_refused``, with the rules that each of the latter
    fails as bits; the counts are those of the rows committed, so a task that
    runs twice changes none.
    """
    now = F.current_timestamp()
    counted = {table: Observation(table) for table in ("quality_feedback", "model_pricing")}
    calls = silver.marked_calls(
        lake.load("bronze", "api_calls_historical"),
        lake.load("bronze", "model_pricing"),
        lake.load_if_exists("bronze", "api_calls_live"),
        now,
    )
    feedback = silver.quality_feedback(lake.load("bronze", "quality_feedback"), now, counted["quality_feedback"])
    prices = silver.model_pricing(lake.load("bronze", "model_pricing"), now, counted["model_pricing"])
    stored = lake.materialize_split(calls, "silver", "api_calls", "api_calls_refused", "event_date" if by_day else None)
    # Neither is shuffled on its way, so that each record is observed once.
    lake.materialize(feedback, "silver", "quality_feedback")
    lake.materialize(prices, "silver", "model_pricing")
    return {"api_calls": silver.marked_counts(stored), **{table: observation.get for table, observation in counted.items()}}


def touched_dates(lake: Lake, since: Column) -> list[date | None]:
    """The dates of calls that reached the bronze tables at ``since`` or later; None stands for times that do not parse."""
    calls = silver.unify_calls(lake.load("bronze", "api_calls_historical"), lake.load_if_exists("bronze", "api_calls_live"))
    found = silver.clean_calls(calls.filter(F.col("ingested_at") >= since)).select("event_date").distinct()
    return [row["event_date"] for row in found.collect()]


def refresh_gold(
    lake: Lake, dates: Sequence[date | None] | None = None, feedback_dates: Sequence[date | None] | None = None
) -> None:
    """The cube of calls, their daily users and user sketches, and the four daily tables.

    With ``dates``, those that ``touched_dates`` names, only the calls of these
    dates are read, and only their rows are written, besides those of the six
    rows after each, whose rolling means reach back to them; a silver table in
    folders by day lets Spark skip all other calls. ``feedback_dates`` does the
    same for feedback, all of which is read where it is not given.
    """
    now = F.current_timestamp()
    calls = lake.load("silver", "api_calls")
    if dates is None:
        cube, users, _ = run_together(
            lambda: lake.materialize(gold.call_cube(calls), "gold", "call_cube"),
            lambda: lake.materialize(gold.daily_users(calls), "gold", "daily_users"),
            lambda: lake.materialize(gold.user_sketches(calls), "gold", "user_sketches"),
        )
        performance = gold.model_performance_summary(None, now, cube=cube, users=users)
        run_together(
            lambda: lake.materialize(gold.daily_cost_by_team(cube, now), "gold", "daily_cost_by_team"),
            lambda: lake.materialize(gold.feature_cost_breakdown(cube, now), "gold", "feature_cost_breakdown"),
            lambda: lake.materialize(performance, "gold", "model_performance_summary"),
        )
    else:
        touched = calls.filter(on_dates("event_date", dates))
        run_together(
            lambda: lake.replace_dates(gold.call_cube(touched), "gold", "call_cube", "event_date", dates),
            lambda: lake.replace_dates(gold.daily_users(touched), "gold", "daily_users", "event_date", dates),
            lambda: lake.replace_dates(gold.user_sketches(touched), "gold", "user_sketches", "event_date", dates),
        )
        upkeep.refresh_cost_tables(lake, dates)
    feedback = lake.load("silver", "quality_feedback")
    if feedback_dates is None:
        lake.materialize(gold.quality_score_daily(feedback, now), "gold", "quality_score_daily")
    else:
        upkeep.refresh_quality(lake, feedback, feedback_dates)


def refresh_models(lake: Lake, model_path: str | None = None, **settings) -> forecast.Forecaster:
    """Train the forecaster and the forest, store them as one version, and their predictions and quality alerts."""
    daily = lake.load("gold", "daily_cost_by_team").drop("gold_loaded_at")
    inputs = features.cost_features(daily)
    quality = features.quality_features(lake.load("gold", "quality_score_daily").drop("gold_loaded_at"))
    forecaster = forecast.train(inputs, **settings)
    forecaster.forest = anomaly.grow_quality_forest(quality)
    if model_path is not None:
        forecast.save(forecaster, model_path)
    lake.materialize(forecast.cost_forecast(forecaster.model, inputs, daily), "gold", "cost_predictions")
    lake.materialize(anomaly.detect_quality_anomalies(quality, grown=forecaster.forest), "gold", "quality_alerts")
    return forecaster


def refresh_alerts(lake: Lake) -> None:
    """Both alert summaries and the project summary."""
    daily = lake.load("gold", "daily_cost_by_team")
    flagged = lake.load("gold", "quality_alerts")
    predictions = lake.load("gold", "cost_predictions")
    lake.materialize(alerts.alert_summary(flagged, daily), "gold", "alert_summary", merge_schema=True)
    ahead = alerts.alert_summary_forecast(predictions, daily, flagged, created_at=F.current_timestamp())
    stored = lake.materialize(ahead, "gold", "alert_summary_forecast", merge_schema=True)
    summary = alerts.project_summary(lake.load("gold", "call_cube"), stored, predictions)
    lake.materialize(summary, "gold", "project_summary")

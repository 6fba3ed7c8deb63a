"""Statistics over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.functions.exact import (
    divide_half_up,
    drop_places,
    from_units,
    mean_places,
    round_places,
    sum_places,
    to_units,
)
from callmeter.operators.durable import cut_lineage
from callmeter.operators.quantile import exact_quantiles
from callmeter.plans.gold import roll_up
from callmeter.schemas import CALL_COST_PLACES, DAILY_COST_PLACES, PERCENT_PLACES


def team_cost_baseline(daily_cost: DataFrame) -> DataFrame:
    """Mean daily cost per team over all history, to six places."""
    unit = to_units("total_cost_usd", DAILY_COST_PLACES)
    widen = F.lit(10 ** (CALL_COST_PLACES - DAILY_COST_PLACES)).cast("long")
    mean = divide_half_up(F.sum(unit) * widen, F.count(unit))
    return daily_cost.groupBy("team").agg(from_units(mean, CALL_COST_PLACES).alias("historical_avg_cost"))


def team_cost_stats(daily_cost: DataFrame) -> DataFrame:
    return daily_cost.groupBy("team").agg(
        mean_places("total_cost_usd", DAILY_COST_PLACES).alias("mean_cost_usd"),
        sum_places("total_cost_usd", DAILY_COST_PLACES, DAILY_COST_PLACES).alias("sum_cost_usd"),
        F.max("total_cost_usd").alias("max_cost_usd"),
    )


def model_quality_stats(quality: DataFrame) -> DataFrame:
    return quality.groupBy("model").agg(
        mean_places("quality_score_pct", PERCENT_PLACES).alias("mean_score"),
        round_places(F.stddev_samp("quality_score_pct"), 2).alias("std_score"),
        F.min("quality_score_pct").alias("min_score"),
        F.max("quality_score_pct").alias("max_score"),
    )


def describe(df: DataFrame, columns: Sequence[str], places: int = 3) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column.

    Quartiles of all columns come from one sort over all partitions, so no
    task holds the values of a column.
    """
    long_form = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    long_form = cut_lineage(long_form)
    stats = long_form.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    cuts = exact_quantiles(long_form, "feature", "value", list(shares.values()))
    cuts = cuts.groupBy(F.col("key").alias("feature")).agg(
        *[F.max(F.when(F.col("share") == share, F.col("quantile"))).alias(name) for name, share in shares.items()]
    )
    return stats.join(cuts, "feature", "left").select(
        "feature", "count", *[round_places(c, places).alias(c) for c in ("mean", "std", "min", *shares, "max")]
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Range, mean and number of predicted days per team, dearest first."""
    unit = to_units("predicted_cost_usd", CALL_COST_PLACES)
    scale = F.lit(10 ** (CALL_COST_PLACES - DAILY_COST_PLACES)).cast("long")
    mean = from_units(divide_half_up(F.sum(unit), F.count(unit) * scale), DAILY_COST_PLACES)
    return (
        predictions.groupBy("team")
        .agg(
            F.min("predicted_cost_usd").alias("min_predicted"),
            F.max("predicted_cost_usd").alias("max_predicted"),
            mean.alias("avg_predicted"),
            F.count(F.lit(1)).alias("days_predicted"),
        )
        .orderBy(F.desc("avg_predicted"), "team")
    )


def dataset_overview(source: DataFrame) -> DataFrame:
    """Size, cost, date range and distinct entities of the calls (or their cube).

    The distinct counts run on the roll-up, not on the calls.
    """
    cube = roll_up(source, "event_date", "team", "feature", "model")
    total = from_units(drop_places(F.sum("cost_micros"), CALL_COST_PLACES, 2), 2)
    return cube.agg(
        F.sum("calls").alias("total_calls"),
        total.alias("total_cost_usd"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
        F.count_distinct("event_date").alias("days_covered"),
        F.count_distinct("team").alias("teams"),
        F.count_distinct("model").alias("models"),
        F.count_distinct("feature").alias("features"),
    )


def series_overview(daily: DataFrame, day: str, key: str) -> DataFrame:
    """Rows, date range and names of the teams or models of a daily table."""
    return daily.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.array_join(F.array_sort(F.collect_set(key)), ", ").alias("names"),
    )


def model_cost_ratio(performance: DataFrame, dear: str = "gpt-4o", cheap: str = "gpt-3.5-turbo") -> DataFrame:
    """Total cost of one model over that of another, and the same per call."""

    def of(model: str, value):
        return F.sum(F.when(F.col("model") == model, value))

    unit = to_units("total_cost_usd", DAILY_COST_PLACES)
    parts = performance.agg(
        of(dear, unit).alias("dear_cost"),
        of(cheap, unit).alias("cheap_cost"),
        of(dear, F.col("total_calls")).alias("dear_calls"),
        of(cheap, F.col("total_calls")).alias("cheap_calls"),
    )
    total = F.try_divide(F.col("dear_cost").cast("double"), F.col("cheap_cost").cast("double"))
    per_call = total * F.try_divide(F.col("cheap_calls").cast("double"), F.col("dear_calls").cast("double"))
    return parts.select(
        F.lit(dear).alias("model"),
        F.lit(cheap).alias("compared_with"),
        round_places(total, 4).alias("total_cost_ratio"),
        round_places(per_call, 4).alias("cost_per_call_ratio"),
    )


def forecast_metrics(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute, root mean squared and mean absolute percentage error."""
    error = F.col(actual) - F.col(predicted)
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        round_places(F.avg(F.abs(error)), 6).alias("mae"),
        round_places(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
        round_places(F.avg(F.abs(error / (F.col(actual) + F.lit(1e-8)))) * 100, 2).alias("mape"),
    )

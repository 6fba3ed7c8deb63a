"""Silver to gold: daily aggregates of calls and feedback.

Every measure of a call is a long that adds up exactly, so the tables below
can be built from the calls or from a finer roll-up of them with the same
result. A refresh reads the calls once into ``call_cube`` and takes the cost
tables from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.functions.columns import stamped
from callmeter.functions.exact import divide_half_up, drop_places, from_units, percent, to_units
from callmeter.operators.windows import last_days, last_rows, with_rolling_mean
from callmeter.schemas import CALL_COST_PLACES, DAILY_COST_PLACES, PERCENT_PLACES

ROLLING = 7
CUBE_KEYS = ("event_date", "team", "feature", "model")
MEASURES = (
    "calls",
    "cost_micros",
    "costed_calls",
    "latency_total",
    "timed_calls",
    "tokens",
    "errors",
    "slow_calls",
)


def call_measures(calls: DataFrame) -> DataFrame:
    """Keys and additive measures of each silver call."""
    return calls.select(
        *CUBE_KEYS,
        "user_id",
        F.lit(1).cast("long").alias("calls"),
        to_units("cost_usd", CALL_COST_PLACES).alias("cost_micros"),
        F.col("cost_usd").isNotNull().cast("long").alias("costed_calls"),
        F.col("latency_ms").cast("long").alias("latency_total"),
        F.col("latency_ms").isNotNull().cast("long").alias("timed_calls"),
        F.col("total_tokens").cast("long").alias("tokens"),
        F.col("is_error").cast("long").alias("errors"),
        F.col("is_slow").cast("long").alias("slow_calls"),
    )


def _measured(source: DataFrame) -> DataFrame:
    return source if "cost_micros" in source.columns else call_measures(source)


def roll_up(source: DataFrame, *keys: str, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Sums of the measures by ``keys``, of calls or of a finer roll-up."""
    return _measured(source).groupBy(*keys).agg(*[F.sum(name).alias(name) for name in MEASURES], *extra)


def call_cube(calls: DataFrame) -> DataFrame:
    """Measures by date, team, feature and model: the finest grain the cost tables need."""
    return roll_up(calls, *CUBE_KEYS)


def _total_cost() -> Column:
    return from_units(drop_places(F.col("cost_micros"), CALL_COST_PLACES, DAILY_COST_PLACES), DAILY_COST_PLACES)


def _cost_per_call() -> Column:
    return from_units(divide_half_up(F.col("cost_micros"), F.col("costed_calls")), CALL_COST_PLACES)


def _mean_latency() -> Column:
    return divide_half_up(F.col("latency_total"), F.col("timed_calls")).cast("double")


def daily_cost_by_team(source: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Spend, calls and errors per day and team, with the mean over the last 7 rows."""
    return stamped(rolling_cost(cost_per_day(source)), "gold_loaded_at", loaded_at)


def cost_per_day(source: DataFrame) -> DataFrame:
    """Spend, calls and errors per day and team."""
    return roll_up(source, "event_date", "team").select(
        "event_date",
        "team",
        _total_cost().alias("total_cost_usd"),
        F.col("calls").alias("total_calls"),
        _cost_per_call().alias("avg_cost_per_call"),
        _mean_latency().alias("avg_latency_ms"),
        F.col("errors").alias("error_count"),
        F.col("slow_calls").alias("slow_call_count"),
        F.col("tokens").alias("total_tokens_used"),
    )


def rolling_cost(daily: DataFrame) -> DataFrame:
    frame = last_rows("team", "event_date", ROLLING)
    return with_rolling_mean(daily, "rolling_7d_avg_cost", "total_cost_usd", DAILY_COST_PLACES, frame)


def rolling_cost_calendar(daily_cost: DataFrame) -> DataFrame:
    """The rolling mean over 7 calendar days; differs from the row form where days are missing."""
    frame = last_days("team", "event_date", ROLLING)
    costs = daily_cost.select("event_date", "team", "total_cost_usd")
    return with_rolling_mean(costs, "rolling_7_calendar_days", "total_cost_usd", DAILY_COST_PLACES, frame)


def _users(approximate: bool) -> Column:
    return (F.approx_count_distinct if approximate else F.count_distinct)("user_id").alias("unique_users")


def daily_users(calls: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct users per day and model, which do not add up from a finer grain."""
    return calls.groupBy("event_date", "model").agg(_users(approximate))


def user_days(calls: DataFrame) -> DataFrame:
    """The distinct users of each day and model, one row each, from which those of several batches can be counted."""
    return calls.select("event_date", "model", "user_id").distinct()


# Of a sketch's registers; the standard error of a count is 1.04 / sqrt(2**12), 1.6 %.
SKETCH_BITS = 12


def user_sketches(calls: DataFrame) -> DataFrame:
    """A sketch of the users of each day, team and model; sketches of any days merge into one of them all."""
    return calls.groupBy("event_date", "team", "model").agg(F.hll_sketch_agg("user_id", SKETCH_BITS).alias("user_sketch"))


def users_over(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """About how many distinct users each group of ``keys`` has, over all days, from the sketches alone."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("user_sketch"))
    return sketches.groupBy(*keys).agg(merged.alias("approximate_users"))


def model_performance_summary(
    calls: DataFrame | None,
    loaded_at: Column | None = None,
    approximate_users: bool = False,
    cube: DataFrame | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Latency, errors, cost and distinct users per day and model.

    Exact distinct users shuffle on (date, model, user) first, so one hot
    model spreads over its users. ``approximate_users`` trades that shuffle
    for a sketch. With a ``cube`` at hand the calls are read for their users
    only: three columns, and rows of three columns in the shuffle; with the
    ``daily_users`` as well they are not read at all.
    """
    if cube is None:
        daily = roll_up(calls, "event_date", "model", extra=(_users(approximate_users),))
    else:
        daily = roll_up(cube, "event_date", "model")
        counted = daily_users(calls, approximate_users) if users is None else users
        counted = counted.withColumnsRenamed({"event_date": "_date", "model": "_model"})
        same = F.col("event_date").eqNullSafe(F.col("_date")) & F.col("model").eqNullSafe(F.col("_model"))
        daily = daily.join(counted, same).drop("_date", "_model")
    summary = daily.select(
        "event_date",
        "model",
        F.col("calls").alias("total_calls"),
        _mean_latency().alias("avg_latency_ms"),
        _total_cost().alias("total_cost_usd"),
        _cost_per_call().alias("avg_cost_per_call"),
        F.col("tokens").alias("total_tokens"),
        percent(F.col("errors"), F.col("calls")).alias("error_rate_pct"),
        percent(F.col("slow_calls"), F.col("calls")).alias("slow_call_rate_pct"),
        "unique_users",
    )
    return stamped(summary, "gold_loaded_at", loaded_at)


def feature_cost_breakdown(source: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Spend per day, team, feature and model."""
    daily = roll_up(source, *CUBE_KEYS).select(
        *CUBE_KEYS,
        F.col("calls").alias("total_calls"),
        _total_cost().alias("total_cost_usd"),
        _mean_latency().alias("avg_latency_ms"),
        F.col("tokens").alias("total_tokens"),
        F.col("errors").alias("error_count"),
    )
    return stamped(daily, "gold_loaded_at", loaded_at)


def quality_score_daily(feedback: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Share of thumbs up per day and model, with the mean over the last 7 rows."""
    return stamped(rolling_quality(quality_per_day(feedback)), "gold_loaded_at", loaded_at)


def quality_per_day(feedback: DataFrame) -> DataFrame:
    """Share of thumbs up per day and model."""
    daily = feedback.groupBy("feedback_date", "model").agg(
        F.count(F.lit(1)).alias("total_feedback"),
        F.sum(F.col("thumbs_up").cast("long")).alias("thumbs_up_count"),
    )
    return daily.withColumn("quality_score_pct", percent(F.col("thumbs_up_count"), F.col("total_feedback")))


def rolling_quality(scored: DataFrame) -> DataFrame:
    frame = last_rows("model", "feedback_date", ROLLING)
    return with_rolling_mean(scored, "rolling_7d_quality_score", "quality_score_pct", PERCENT_PLACES, frame)

"""Feature tables for the cost and quality learners.

All run on daily gold tables: one window sort per team or model, over as many
rows as there are days of history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callmeter.functions.columns import calendar_columns, code_of
from callmeter.functions.exact import mean_over
from callmeter.operators.moments import mean_of, population_deviation
from callmeter.operators.windows import rows_before, series
from callmeter.schemas import MODEL_CODES, PERCENT_PLACES, TEAM_CODES

# Lags in rows, and the learners' inputs in order.
COST_LAGS = (1, 3, 7, 14, 30)
COST_FEATURES = (
    "day_of_week",
    "day_of_month",
    "month",
    "week_of_year",
    "is_weekend",
    "cost_lag_1d",
    "cost_lag_3d",
    "cost_lag_7d",
    "cost_lag_14d",
    "cost_lag_30d",
    "rolling_mean_7d",
    "rolling_mean_14d",
    "rolling_std_7d",
    "total_calls",
    "rolling_7d_avg_cost",
    "team_encoded",
)
QUALITY_FEATURES = (
    "quality_score_pct",
    "rolling_7d_quality_score",
    "deviation_from_7d_avg",
    "z_score",
    "rolling_std_7d",
    "day_over_day_change",
    "quality_lag_1d",
    "quality_lag_7d",
    "day_of_week",
    "month",
    "model_encoded",
)
SPIKE_FEATURES = ("total_cost_usd", "total_calls", "rolling_7d_avg_cost", "day_of_week")

TEST_DAYS = 14
HORIZON_DAYS = 30
# Keeps the z-score finite for a model whose score never changes.
STD_FLOOR = 1e-8


def cost_features(daily_cost: DataFrame, leak_free: bool = False) -> DataFrame:
    """Daily cost with date, lag and rolling features; rows with any NULL are dropped.

    By default the same day's call count and rolling mean are inputs, although
    the latter contains the target. ``leak_free`` takes both from the previous
    row.
    """
    w = series("team", "event_date")

    def before(rows: int):
        return rows_before("team", "event_date", rows)

    cost = F.col("total_cost_usd")
    derived = {
        **calendar_columns("event_date"),
        **{f"cost_lag_{k}d": F.lag(cost, k).over(w) for k in COST_LAGS},
        "rolling_mean_7d": F.avg(cost).over(before(7)),
        "rolling_mean_14d": F.avg(cost).over(before(14)),
        "rolling_std_7d": F.coalesce(F.stddev_samp(cost).over(before(7)), F.lit(0.0)),
        "team_encoded": code_of("team", TEAM_CODES),
    }
    if leak_free:
        for name in ("total_calls", "rolling_7d_avg_cost"):
            derived[name] = F.lag(name, 1).over(w)
    return daily_cost.withColumns(derived).na.drop("any")


def _split_day(features: DataFrame, test_days: int):
    return F.date_sub(features.agg(F.max("event_date")).scalar(), test_days)


def label_split(features: DataFrame, test_days: int = TEST_DAYS) -> DataFrame:
    """Mark each row 'train' or 'test'; the last ``test_days`` days are the test."""
    late = F.col("event_date") > _split_day(features, test_days)
    return features.withColumn("split", F.when(late, F.lit("test")).otherwise(F.lit("train")))


def train_test_split(features: DataFrame, test_days: int = TEST_DAYS) -> tuple[DataFrame, DataFrame]:
    day = _split_day(features, test_days)
    return features.filter(F.col("event_date") <= day), features.filter(F.col("event_date") > day)


def team_last_profile(features: DataFrame) -> DataFrame:
    """The most recent history of each team, as inputs for days to come.

    A lag that reaches further back than the team's history is replaced by the
    team's mean cost.
    """
    recent = Window.partitionBy("team").orderBy(F.desc("event_date"))
    ranked = features.select("team", "event_date", "total_cost_usd", "total_calls", "rolling_7d_avg_cost").withColumn(
        "back", F.row_number().over(recent)
    )
    cost, back = F.col("total_cost_usd"), F.col("back")

    def tail(rows: int, value=cost):
        return F.when(back <= rows, value)

    lags = [
        F.coalesce(F.max(F.when(back == k, cost)), F.avg(cost)).alias(f"cost_lag_{k}d") for k in COST_LAGS
    ]
    return ranked.groupBy("team").agg(
        *lags,
        F.avg(tail(7)).alias("rolling_mean_7d"),
        F.avg(tail(14)).alias("rolling_mean_14d"),
        F.coalesce(F.stddev_samp(tail(7)), F.lit(0.0)).alias("rolling_std_7d"),
        F.avg(tail(7, F.col("total_calls"))).alias("total_calls"),
        F.max(F.when(back == 1, F.col("rolling_7d_avg_cost"))).alias("rolling_7d_avg_cost"),
    )


def forecast_frame(features: DataFrame, daily_cost: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """One input row per team and future day.

    Days count from the last date of any team. Only the date features change
    along the horizon.
    """
    last_day = daily_cost.agg(F.max("event_date")).scalar()
    horizon = F.explode(F.sequence(F.lit(1), F.lit(days))).alias("prediction_horizon_days")
    ahead = team_last_profile(features).select("*", horizon)
    dated = ahead.withColumn("prediction_date", F.date_add(last_day, F.col("prediction_horizon_days")))
    return dated.withColumns(
        {**calendar_columns("prediction_date"), "team_encoded": code_of("team", TEAM_CODES)}
    )


def forecast_coverage(features: DataFrame, daily_cost: DataFrame) -> DataFrame:
    """Days of history and usable feature rows per team; a team without the latter gets no forecast."""
    used = features.groupBy("team").agg(F.count(F.lit(1)).alias("_used"))
    rows = F.coalesce(F.col("_used"), F.lit(0).cast("long"))
    history = daily_cost.groupBy("team").agg(F.count(F.lit(1)).alias("history_rows"))
    return history.join(used, "team", "left").select(
        "team", "history_rows", rows.alias("feature_rows"), (rows > 0).alias("has_forecast")
    )


def quality_features(quality: DataFrame) -> DataFrame:
    """Daily scores with their distance from recent and overall history; rows with any NULL are dropped."""
    w = series("model", "feedback_date")
    whole = Window.partitionBy("model")
    score = F.col("quality_score_pct")
    mean = mean_over("quality_score_pct", PERCENT_PLACES, whole)
    derived = {
        "deviation_from_7d_avg": score - F.col("rolling_7d_quality_score"),
        "z_score": (score - mean) / (F.stddev_samp(score).over(whole) + F.lit(STD_FLOOR)),
        "rolling_std_7d": F.coalesce(
            F.stddev_samp(score).over(rows_before("model", "feedback_date", 7)), F.lit(0.0)
        ),
        "day_over_day_change": F.coalesce(score - F.lag(score, 1).over(w), F.lit(0.0)),
        "quality_lag_1d": F.coalesce(F.lag(score, 1).over(w), mean),
        "quality_lag_7d": F.coalesce(F.lag(score, 7).over(w), mean),
        "day_of_week": F.weekday("feedback_date"),
        "month": F.month("feedback_date"),
        "model_encoded": code_of("model", MODEL_CODES),
    }
    return quality.withColumns(derived).na.drop("any")


def spike_features(daily_cost: DataFrame) -> DataFrame:
    """Inputs of the cost anomaly detector."""
    return daily_cost.withColumn("day_of_week", F.weekday("event_date")).na.drop(
        "any", subset=["event_date", "team", *SPIKE_FEATURES]
    )


def standardise(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Scale columns to mean 0 and population deviation 1; a constant column becomes 0."""
    wide = df.withColumns({c: F.col(c).cast("double") for c in columns})
    moments = wide.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        )
    ).scalar()
    # One column holds the moments, so that they are worked out once and not
    # once for every place they are used in.
    joined = wide.withColumn("_moments", moments)
    spread = {c: F.col(f"_moments.{c}_std") for c in columns}
    return joined.withColumns(
        {
            c: (F.col(c) - F.col(f"_moments.{c}_mean")) / F.when(spread[c] == 0, F.lit(1.0)).otherwise(spread[c])
            for c in columns
        }
    ).drop("_moments")


def scaled_by(df: DataFrame, moments: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``standardise`` by merged moments (one row) of all rows seen so far, which need not be at hand."""
    told = moments.select(F.struct(*[mean_of(c).alias(f"{c}_mean") for c in columns], *[population_deviation(c).alias(f"{c}_std") for c in columns]))
    joined = df.withColumns({c: F.col(c).cast("double") for c in columns}).withColumn("_moments", told.scalar())
    spread = {c: F.col(f"_moments.{c}_std") for c in columns}
    return joined.withColumns(
        {
            c: (F.col(c) - F.col(f"_moments.{c}_mean")) / F.when(spread[c] == 0, F.lit(1.0)).otherwise(spread[c])
            for c in columns
        }
    ).drop("_moments")

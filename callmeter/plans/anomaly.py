"""Quality and cost anomalies: control limits, isolation forest, severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.functions.exact import mean_over, round_places
from callmeter.operators import forest
from callmeter.operators.durable import cut_lineage
from callmeter.operators.moments import mean_of, partial_moments, sample_deviation
from callmeter.plans.features import QUALITY_FEATURES, SPIKE_FEATURES, standardise
from callmeter.schemas import PERCENT_PLACES

# Fixed values of the detector.
TREES = 200
CONTAMINATION = 0.05
SEED = 42
SIGMAS = 2

ALERT_COLUMNS = (
    "feedback_date",
    "model",
    "quality_score_pct",
    "rolling_7d_quality_score",
    "stat_threshold",
    "deviation_from_7d_avg",
    "z_score",
    "if_anomaly",
    "stat_anomaly",
    "is_anomaly",
    "if_anomaly_score",
    "total_feedback",
)


def control_limits(features: DataFrame) -> DataFrame:
    """Lower control limit per model, and the days that fall below it."""
    whole = Window.partitionBy("model")
    score = F.col("quality_score_pct")
    limited = features.withColumn("quality_mean", mean_over("quality_score_pct", PERCENT_PLACES, whole)).withColumn(
        "stat_threshold", F.col("quality_mean") - F.lit(SIGMAS) * F.stddev_samp(score).over(whole)
    )
    # A model with a single day has no deviation, hence no limit and no anomaly.
    return limited.withColumn("stat_anomaly", F.coalesce(score < F.col("stat_threshold"), F.lit(False)).cast("int"))


def quality_moments(features: DataFrame) -> DataFrame:
    """Per model the moments of some days' scores, to be kept and merged with those of other days."""
    return partial_moments(features, ("quality_score_pct",), "model")


def limits_from(moments: DataFrame, days: DataFrame) -> DataFrame:
    """Control limits of ``days`` from merged moments of the history, none of which is read."""
    limits = moments.select(
        F.col("model").alias("_model"),
        mean_of("quality_score_pct").alias("quality_mean"),
        (mean_of("quality_score_pct") - F.lit(SIGMAS) * sample_deviation("quality_score_pct")).alias("stat_threshold"),
    )
    limited = days.join(limits, F.col("model").eqNullSafe(F.col("_model")), "left").drop("_model")
    below = F.col("quality_score_pct") < F.col("stat_threshold")
    return limited.withColumn("stat_anomaly", F.coalesce(below, F.lit(False)).cast("int"))


def severity(is_anomaly: Column, z_score: Column) -> Column:
    """'critical' for an anomaly far below the mean, 'warning' for any other, else 'normal'."""
    return (
        F.when(is_anomaly & (z_score < -2), F.lit("critical"))
        .when(is_anomaly & (z_score >= -2), F.lit("warning"))
        .otherwise(F.lit("normal"))
    )


def quality_alerts(flagged: DataFrame) -> DataFrame:
    """Every day with its flags and severity.

    ``flagged`` has the statistical flag and, if the forest ran, its flag and
    score; without them only the control limit decides.
    """
    if "if_anomaly" not in flagged.columns:
        flagged = flagged.withColumns({"if_anomaly": F.lit(0), "if_anomaly_score": F.lit(None).cast("double")})
    either = (F.col("if_anomaly") == 1) | (F.col("stat_anomaly") == 1)
    return (
        flagged.withColumn("is_anomaly", either.cast("int"))
        .select(*ALERT_COLUMNS)
        .withColumn("alert_severity", severity(F.col("is_anomaly") == 1, F.col("z_score")))
    )


def _scaled(df: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, tuple[str, ...]]:
    """The stored rows with their scaled columns, under names of their own."""
    named = {c: f"scaled_{c}" for c in columns}
    ready = cut_lineage(df).withColumns({new: F.col(old) for old, new in named.items()})
    return standardise(ready, tuple(named.values())), tuple(named.values())


def score_with_forest(
    df: DataFrame,
    columns: tuple[str, ...],
    keys: tuple[str, ...],
    trees: int = TREES,
    seed: int = SEED,
    grown: forest.IsolationForest | None = None,
) -> DataFrame:
    """Add ``if_anomaly_score`` and ``if_anomaly`` from a forest on the scaled columns, one that is ``grown`` already or a new one."""
    scaled, names = _scaled(df, columns)
    model = grown or forest.fit(scaled, names, keys, trees=trees, seed=seed)
    scored = cut_lineage(scaled.withColumn("if_anomaly_score", model.score_column(scaled)).drop(*names))
    return forest.flag_share(scored, "if_anomaly_score", "if_anomaly", CONTAMINATION)


def grow_quality_forest(features: DataFrame, trees: int = TREES, seed: int = SEED) -> forest.IsolationForest:
    """The forest that ``detect_quality_anomalies`` grows, to be stored."""
    scaled, names = _scaled(features, QUALITY_FEATURES)
    return forest.fit(scaled, names, ("feedback_date", "model"), trees=trees, seed=seed)


def detect_quality_anomalies(
    features: DataFrame, trees: int = TREES, seed: int = SEED, grown: forest.IsolationForest | None = None
) -> DataFrame:
    """Quality alerts from forest and control limits together."""
    scored = score_with_forest(features, QUALITY_FEATURES, ("feedback_date", "model"), trees, seed, grown)
    return quality_alerts(control_limits(scored))


def detect_cost_anomalies(spikes: DataFrame, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """Daily cost rows with the forest's score and flag."""
    scored = score_with_forest(spikes, SPIKE_FEATURES, ("event_date", "team"), trees, seed)
    return scored.select("event_date", "team", *SPIKE_FEATURES, "if_anomaly_score", "if_anomaly")


def anomaly_totals(alerts: DataFrame) -> DataFrame:
    """Days, anomalies and their share: overall, per model and per severity, in one pass."""
    flagged = F.sum(F.col("is_anomaly").cast("long"))
    return alerts.groupingSets([[], ["model"], ["alert_severity"]], "model", "alert_severity").agg(
        F.count(F.lit(1)).alias("day_count"),
        flagged.alias("anomalies"),
        round_places(flagged.cast("double") * 100 / F.count(F.lit(1)), 2).alias("anomaly_rate_pct"),
    )

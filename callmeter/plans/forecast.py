"""Cost forecast: train on daily history, predict 30 days per team."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from callmeter.functions.exact import round_places
from callmeter.operators import forest
from callmeter.operators.durable import cut_lineage
from callmeter.plans.features import (
    COST_FEATURES,
    HORIZON_DAYS,
    TEST_DAYS,
    forecast_frame,
    label_split,
    train_test_split,
)
from callmeter.plans.stats import forecast_metrics
from callmeter.schemas import CALL_COST_PLACES

# Fixed values of the regressor.
SETTINGS = {
    "maxIter": 300,
    "maxDepth": 4,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}


# Rows of training input stored beside a model, to show what it expects.
SAMPLE_ROWS = 5


@dataclass
class Forecaster:
    """A fitted model with its settings, its training and test figures and a few input rows; the quality forest beside it."""

    model: PipelineModel
    settings: dict
    metrics: DataFrame
    sample: DataFrame
    forest: forest.IsolationForest | None = None


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``predicted_cost_usd`` to rows with the 16 inputs; a cost is never negative."""
    raw = model.transform(rows.withColumns({c: F.col(c).cast("double") for c in COST_FEATURES}))
    clipped = F.greatest(F.col("prediction"), F.lit(0.0))
    return raw.withColumn("predicted_cost_usd", clipped).drop("features", "prediction")


def train(features: DataFrame, test_days: int = TEST_DAYS, **changed) -> Forecaster:
    """Fit the boosted trees on all but the last ``test_days`` days and test on those.

    The features are checkpointed first: boosting reads them for every level
    of every tree.
    """
    settings = {**SETTINGS, **changed}
    marked = label_split(features, test_days)
    ready = cut_lineage(marked.select("event_date", "team", "total_cost_usd", "split", *COST_FEATURES))
    inputs = ready.withColumns({c: F.col(c).cast("double") for c in COST_FEATURES})
    training = inputs.filter(F.col("split") == "train")
    learner = GBTRegressor(featuresCol="features", labelCol="total_cost_usd", lossType="squared", **settings)
    assembler = VectorAssembler(inputCols=list(COST_FEATURES), outputCol="features")
    model = Pipeline(stages=[assembler, learner]).fit(training)
    test = predict(model, ready.filter(F.col("split") == "test"))
    errors = forecast_metrics(test, "total_cost_usd", "predicted_cost_usd")
    first = training.orderBy("team", "event_date").limit(SAMPLE_ROWS)
    metrics = errors.withColumn("train_rows", F.lit(training.count()))
    return Forecaster(model, settings, metrics, first.select("total_cost_usd", *COST_FEATURES))


def feature_importance(forecaster: Forecaster, spark: SparkSession) -> DataFrame:
    """The model's inputs by importance, highest first."""
    weights = forecaster.model.stages[-1].featureImportances.toArray()
    rows = [Row(feature=name, importance=float(w)) for name, w in zip(COST_FEATURES, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def _as_predictions(rows: DataFrame) -> DataFrame:
    return rows.select(
        "prediction_date",
        "team",
        round_places("predicted_cost_usd", CALL_COST_PLACES).alias("predicted_cost_usd"),
        "prediction_horizon_days",
    )


def cost_forecast(
    model: PipelineModel, features: DataFrame, daily_cost: DataFrame, days: int = HORIZON_DAYS
) -> DataFrame:
    """Predicted cost per team and day ahead."""
    return _as_predictions(predict(model, forecast_frame(features, daily_cost, days)))


def naive_forecast(features: DataFrame, daily_cost: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """The mean of each team's last seven rows for every day ahead: the yardstick for the model."""
    frame = forecast_frame(features, daily_cost, days)
    return _as_predictions(frame.withColumn("predicted_cost_usd", F.col("rolling_mean_7d")))


def naive_metrics(features: DataFrame, test_days: int = TEST_DAYS) -> DataFrame:
    """Test errors of predicting the mean of the seven rows before."""
    _, test = train_test_split(features, test_days)
    return forecast_metrics(test, "total_cost_usd", "rolling_mean_7d")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions of the model below ``path``, in order."""
    try:
        found = spark.read.schema("version long").parquet(f"{path}/v*/complete").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r["version"] for r in found)


def save(forecaster: Forecaster, path: str) -> int:
    """Store the model as a new version below ``path`` and return its number.

    A version holds the model, a one-row table of its settings, inputs and
    figures, a few input rows, and the forest that was trained beside it, if
    any. Its last write marks it as complete: until then, and after a failure,
    the version before is the one that is loaded. Versions are never changed;
    one that was not completed is written anew.
    """
    spark = forecaster.metrics.sparkSession
    number = max(versions(spark, path), default=0) + 1
    folder = f"{path}/v{number}"
    forecaster.model.write().overwrite().save(f"{folder}/model")
    described = forecaster.metrics.select(
        F.lit(json.dumps(forecaster.settings, sort_keys=True)).alias("settings"),
        F.lit(json.dumps(COST_FEATURES)).alias("features"),
        F.lit(forecaster.sample.schema.json()).alias("input_schema"),
        F.lit(forecaster.forest is not None).alias("has_forest"),
        "*",
    )
    described.write.mode("overwrite").parquet(f"{folder}/training")
    forecaster.sample.write.mode("overwrite").parquet(f"{folder}/sample")
    if forecaster.forest is not None:
        forest.save(forecaster.forest, spark, f"{folder}/forest")
    spark.range(number, number + 1).select(F.col("id").alias("version")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/complete")
    return number


def load(spark: SparkSession, path: str, version: int | None = None) -> Forecaster:
    """A stored model: of ``version``, or of the last complete one."""
    complete = versions(spark, path)
    number = max(complete, default=None) if version is None else version
    if number not in complete:
        raise FileNotFoundError(f"no complete version {version or ''} of a model below {path}")
    folder = f"{path}/v{number}"
    training = spark.read.parquet(f"{folder}/training")
    told = training.select("settings", "has_forest").first()
    metrics, sample = training.drop("settings", "features", "input_schema", "has_forest"), spark.read.parquet(f"{folder}/sample")
    grown = forest.load(spark, f"{folder}/forest") if told["has_forest"] else None
    return Forecaster(PipelineModel.load(f"{folder}/model"), json.loads(told["settings"]), metrics, sample, grown)

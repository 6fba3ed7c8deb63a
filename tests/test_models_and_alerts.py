from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from builders import daily_cost, day
from callmeter.plans import alerts, anomaly, features, forecast


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(5)
    rows = [
        (d, team, round(level + float(rng.uniform(0, 1)), 4), int(rng.integers(5, 20)), level + 0.5)
        for team, level in (("product", 1.0), ("data", 3.0))
        for d in range(80)
    ]
    return daily_cost(spark, *rows).cache()


@pytest.fixture(scope="module")
def trained(history):
    return forecast.train(features.cost_features(history), maxIter=8, stepSize=0.3)


def test_metrics_are_finite_and_small(trained):
    row = trained.metrics.first()
    assert (row.train_rows, row.test_rows) == (72, 28)
    assert 0 < row.mae <= row.rmse < 1 and row.mape < 100


def test_forecast_rows(history, trained):
    got = forecast.cost_forecast(trained.model, features.cost_features(history), history).toPandas()
    assert len(got) == 60 and (got["predicted_cost_usd"] >= 0).all()
    assert set(got["prediction_horizon_days"]) == set(range(1, 31))
    by_team = got.groupby("team")["predicted_cost_usd"].mean()
    assert by_team["data"] > by_team["product"]


def test_predictions_are_clipped(history, trained):
    low = features.cost_features(history.withColumn("total_cost_usd", F.lit(-5.0)))
    fitted = forecast.train(low, maxIter=2)
    assert forecast.predict(fitted.model, low).agg(F.max("predicted_cost_usd")).first()[0] == 0.0


def test_same_seed_same_model(history, trained):
    again = forecast.train(features.cost_features(history), maxIter=8, stepSize=0.3)
    assert again.metrics.first() == trained.metrics.first()


def test_importance(spark, trained):
    ranked = forecast.feature_importance(trained, spark).toPandas()
    assert len(ranked) == 16 and np.isclose(ranked["importance"].sum(), 1)
    assert ranked["importance"].is_monotonic_decreasing


def test_save_and_load(spark, history, trained, tmp_path):
    forecast.save(trained, str(tmp_path / "m"))
    back = forecast.load(spark, str(tmp_path / "m"))
    inputs = features.cost_features(history)
    ours, theirs = (
        forecast.predict(m.model, inputs).agg(F.sum("predicted_cost_usd")).first()[0] for m in (trained, back)
    )
    assert back.sample.count() == 5 and set(features.COST_FEATURES) < set(back.sample.columns)
    assert ours == theirs and back.settings == trained.settings and back.metrics.first() == trained.metrics.first()


def test_batch_score_of_supplied_rows(spark, trained):
    """Rows with the 16 inputs and nothing else: all zero, and each input at its number in the list."""
    names = ", ".join(f"{name} double" for name in features.COST_FEATURES)
    rows = [tuple([0.0] * 16), tuple(float(i) for i in range(16))]
    scored = forecast.predict(trained.model, spark.createDataFrame(rows, names)).collect()
    assert len(scored) == 2 and all(r.predicted_cost_usd >= 0 for r in scored)


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(88, 1, 60)
    values[30] = 70.0
    rows = [(day(i), "gpt-4o", 30, round(float(v), 2), 88.0) for i, v in enumerate(values)]
    rows.append((day(0), "claude-3-sonnet", 30, 90.0, 90.0))
    return spark.createDataFrame(
        rows,
        "feedback_date date, model string, total_feedback long, quality_score_pct double, rolling_7d_quality_score double",
    ).cache()


def test_planted_drop_is_critical(scores):
    found = anomaly.detect_quality_anomalies(features.quality_features(scores), trees=40)
    drop = found.filter(F.col("quality_score_pct") == 70.0).first()
    assert (drop.stat_anomaly, drop.if_anomaly, drop.is_anomaly, drop.alert_severity) == (1, 1, 1, "critical")
    assert found.count() == 60  # the one-day model has no z-score and drops out
    levels = {(r.is_anomaly, r.alert_severity) for r in found.collect()}
    assert levels <= {(0, "normal"), (1, "warning"), (1, "critical")}


def test_single_day_has_no_limit(scores):
    one = features.quality_features(scores.filter("model = 'gpt-4o'").limit(0).unionByName(scores.limit(1))).count()
    assert one == 0


@pytest.mark.parametrize("score", [91.2, 88.87, 70.01])
def test_steady_quality_is_no_anomaly(spark, score):
    """Eleven equal scores: a mean in doubles may come out above them."""
    same = spark.createDataFrame(
        [(day(i), "gpt-4o", 30, score, score) for i in range(11)],
        "feedback_date date, model string, total_feedback long, quality_score_pct double, rolling_7d_quality_score double",
    )
    limited = anomaly.control_limits(features.quality_features(same))
    assert limited.agg(F.sum("stat_anomaly"), F.max(F.abs("z_score"))).first()[:] == (0, 0.0)


def test_forest_share(scores):
    scored = anomaly.score_with_forest(
        features.quality_features(scores), features.QUALITY_FEATURES, ("feedback_date", "model"), trees=40
    )
    assert scored.agg(F.sum("if_anomaly")).first()[0] == 3  # 5 % of 60


def test_cost_anomalies(history):
    spiked = history.withColumn(
        "total_cost_usd",
        F.when((F.col("event_date") == F.lit(day(40))) & (F.col("team") == "data"), 50.0).otherwise(F.col("total_cost_usd")),
    )
    found = anomaly.detect_cost_anomalies(features.spike_features(spiked), trees=40)
    worst = found.orderBy("if_anomaly_score").first()
    assert (worst.event_date, worst.team, worst.if_anomaly) == (day(40), "data", 1)


def test_severity_edges(spark):
    cases = spark.createDataFrame([(1, -2.5), (1, -2.0), (1, 3.0), (0, -9.0)], "a int, z double")
    got = [r[0] for r in cases.select(anomaly.severity(F.col("a") == 1, F.col("z"))).collect()]
    assert got == ["critical", "warning", "warning", "normal"]


def alert_rows(spark):
    return spark.createDataFrame(
        [(day(1), "gpt-4o", 70.25, 88.0, 1, "critical"), (day(0), "gpt-4o", 88.0, 88.0, 0, "normal")],
        "feedback_date date, model string, quality_score_pct double, rolling_7d_quality_score double, is_anomaly int, alert_severity string",
    )


def test_alert_summary(spark):
    costs = daily_cost(spark, (2, "ops", 1.5001, 1, 1.0), (3, "ops", 1.5, 1, 1.0), (4, "ops", 1.0, 1, 0.0))
    summary = alerts.alert_summary(alert_rows(spark), costs)
    got = {r.alert_type: r for r in summary.collect()}
    assert summary.count() == 2
    assert got["quality_drop"].alert_message == "Quality dropped to 70.3% (rolling avg: 88.0%)"
    assert got["cost_spike"].alert_message == "Daily cost $1.500 exceeds 150% of 7-day avg $1.000"
    assert (got["cost_spike"].alert_date, got["cost_spike"].model, got["cost_spike"].team) == (day(2), None, "ops")
    assert alerts.alerts_view(summary, severity="critical").count() == 1
    assert alerts.alerts_view(summary, alert_type="cost_spike").first().deviation == 0.5001
    assert tuple(alerts.alert_counters(summary).first()) == (2, 1, 1)


def test_large_numbers_in_messages_have_fixed_decimals(spark):
    costs = daily_cost(spark, (2, "ops", 12345678.5, 1, 1.0))
    (row,) = alerts.alert_summary(alert_rows(spark).limit(0), costs).collect()
    assert row.alert_message == "Daily cost $12345678.500 exceeds 150% of 7-day avg $1.000"


def test_predicted_levels(spark):
    costs = daily_cost(spark, (0, "ops", 1.0, 1, 1.0))
    ahead = spark.createDataFrame(
        [(day(9), t, p, 1) for t, p in (("ops", 1.2), ("ops", 1.21), ("ops", 1.5), ("ops", 1.51), ("new", 99.0))],
        "prediction_date date, team string, predicted_cost_usd double, prediction_horizon_days int",
    )
    got = alerts.predicted_cost_alerts(ahead, costs).orderBy("metric_value")
    assert [(r.severity, r.is_alert) for r in got.collect()] == [
        ("normal", False),
        ("warning", True),
        ("warning", True),
        ("critical", True),
        ("normal", False),
    ]


def test_every_day_can_count_as_alert(spark):
    costs = daily_cost(spark, (0, "ops", 1.0, 1, 1.0))
    none = spark.createDataFrame([], "prediction_date date, team string, predicted_cost_usd double, prediction_horizon_days int")
    raised = [
        alerts.alert_summary_forecast(none, costs, alert_rows(spark), flag_every_day=flag).filter("is_alert").count()
        for flag in (False, True)
    ]
    assert raised == [1, 2]

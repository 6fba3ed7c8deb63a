"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from callmeter.plans import forecast
from check_oracles import connect, difference

# The queries of callmeter.llm have tests of their own.
ORACLE = {name: sql for name, sql in registered.oracle_sql().items() if name in registered.oracles.QUERIES}
LEARNED = {
    "cost_forecast",
    "forecast_metrics",
    "feature_importance",
    "batch_score",
    "quality_alerts",
    "quality_forest_scores",
    "cost_forest_scores",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_only_learned_results_lack_sql():
    own = set(registered._QUERIES)
    assert own - set(ORACLE) == LEARNED
    assert set(ORACLE) <= own <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, duck, name):
    result = registered.queries()[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    found = difference(result.toArrow(), duck.sql(ORACLE[name]).to_arrow_table())
    assert found is None, found


def test_forecast_queries(spark, sf_dir, monkeypatch):
    """The queries on the trained model, with a few trees instead of 300."""
    monkeypatch.setitem(forecast.SETTINGS, "maxIter", 3)
    rows = {"cost_forecast": 150, "forecast_metrics": 1, "feature_importance": 16, "batch_score": 1221}
    run = {name: registered.queries()[name](spark, sf_dir).toArrow() for name in rows}
    assert {name: table.num_rows for name, table in run.items()} == rows
    naive = registered.queries()["naive_forecast"](spark, sf_dir).toArrow()
    assert run["cost_forecast"].schema == naive.schema


@pytest.mark.parametrize("name", ["quality_alerts", "quality_forest_scores", "cost_forest_scores"])
def test_forest_queries(spark, sf_dir, name):
    table = registered.queries()[name](spark, sf_dir).toPandas()
    assert table["if_anomaly_score"].between(-1, 0).all()
    # Below the 5 % quantile lie at most 5 % of the rows, and close to that many.
    assert 0.03 < table["if_anomaly"].mean() <= 0.06


def test_forest_flags_add_to_the_control_limits(spark, sf_dir):
    both = registered.queries()["quality_alerts"](spark, sf_dir)
    stat = registered.queries()["quality_alerts_stat"](spark, sf_dir)
    assert both.dtypes == stat.dtypes
    keys = ["feedback_date", "model"]
    assert stat.filter("is_anomaly = 1").join(both.filter("is_anomaly = 0"), keys).isEmpty()


def test_differences_are_found(spark, duck, sf_dir):
    """The comparison itself: a change in the last place of one sum must show."""
    result = registered.queries()["team_cost_stats"](spark, sf_dir).toArrow()
    off = ORACLE["team_cost_stats"].replace("max(total_cost_usd) AS", "max(total_cost_usd) + 1e-4 AS")
    assert "rows differ" in difference(result, duck.sql(off).to_arrow_table())


def test_entry_has_rows(spark):
    assert registered.entry(spark).limit(1).count() == 1

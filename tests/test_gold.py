from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from builders import calls, daily_cost, day, prices
from callmeter import fixtures
from callmeter.plans import gold, serving, silver, stats


def stored(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_cube_gives_the_same_tables(spark, sf_dir):
    dirty = silver.api_calls(fixtures.calls_dirty(spark, sf_dir), fixtures.prices(spark))
    cube = gold.call_cube(dirty)
    for build in (gold.daily_cost_by_team, gold.feature_cost_breakdown, stats.dataset_overview):
        assert stored(build(dirty)) == stored(build(cube))
    by_cube = gold.model_performance_summary(dirty, cube=cube)
    assert stored(by_cube) == stored(gold.model_performance_summary(dirty))
    assert by_cube.filter("event_date is null").count() > 0


def test_group_without_any_cost(spark):
    unpriced = silver.api_calls(calls(spark, {"model": "claude-3-sonnet"}), prices(spark))
    row = gold.daily_cost_by_team(unpriced).first()
    assert (row.total_cost_usd, row.avg_cost_per_call, row.rolling_7d_avg_cost, row.total_calls) == (None, None, None, 1)


def test_unparsed_times_form_a_group(spark):
    some = silver.api_calls(calls(spark, {"timestamp": "x"}, {}), prices(spark))
    assert {r.event_date for r in gold.daily_cost_by_team(some).collect()} == {None, date(2025, 11, 8)}


def test_row_and_calendar_frames_differ_over_gaps(spark):
    gaps = [(0, "2026-01-01"), (1, "2026-01-02"), (2, "2026-02-01")]
    some = silver.api_calls(
        calls(spark, *[{"call_id": str(i), "timestamp": f"{d}T00:00:00Z", "prompt_tokens": 1000 * (i + 1), "completion_tokens": 0} for i, d in gaps]),
        prices(spark),
    )
    daily = gold.daily_cost_by_team(some)
    by_row = [r.rolling_7d_avg_cost for r in daily.orderBy("event_date").collect()]
    by_day = [r.rolling_7_calendar_days for r in gold.rolling_cost_calendar(daily).orderBy("event_date").collect()]
    assert by_row == [0.005, 0.0075, 0.01]
    assert by_day == [0.005, 0.0075, 0.015]


def test_costs_are_rounded_per_call_before_the_sum(spark):
    # 400 calls of 0.0000005 dollars, each of which rounds to 0.000001.
    tiny = [{"call_id": str(i), "prompt_tokens": 1, "completion_tokens": 0} for i in range(400)]
    some = silver.api_calls(calls(spark, *tiny), prices(spark, ("gpt-4o", "0.0005", "0", "p")))
    assert gold.daily_cost_by_team(some).first().total_cost_usd == 0.0004


def test_users_exact_and_approximate(spark, sf_dir):
    clean = silver.api_calls(fixtures.calls(spark, sf_dir), fixtures.prices(spark))
    exact = gold.model_performance_summary(clean).agg(F.sum("unique_users")).first()[0]
    rough = gold.model_performance_summary(clean, approximate_users=True).agg(F.sum("unique_users")).first()[0]
    assert abs(rough - exact) <= 0.05 * exact


def test_latest_quality_skips_missing_values(spark):
    scores = spark.createDataFrame(
        [(day(0), "m", 80.0, 80.0), (day(1), "m", 90.0, None)],
        "feedback_date date, model string, quality_score_pct double, rolling_7d_quality_score double",
    )
    row = serving.latest_quality_by_model(scores).first()
    assert (row.feedback_date, row.quality_score_pct, row.rolling_7d_quality_score) == (day(1), 90.0, 80.0)


def test_team_filter_and_months(spark):
    costs = daily_cost(spark, (0, "data", 1.25, 1, 0), (20, "ops", 2.0, 1, 0), (40, "data", 4.0, 1, 0))
    as_of = F.lit("2026-02-10").cast("date")
    assert serving.kpi_total_spend(costs).first().val == 7.25
    assert serving.kpi_total_spend(costs, ["data"]).first().val == 5.25
    assert serving.kpi_total_spend(costs, []).first().val == 7.25
    assert serving.spend_this_month(costs, as_of).first().val == 4.0
    assert tuple(serving.top_team_last_month(costs, as_of).first()) == ("ops", 2.0)

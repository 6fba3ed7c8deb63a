from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from builders import calls, prices
from callmeter.operators.joins import lookup_join
from callmeter.plans import silver
from callmeter.sources.readers import decode_calls


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize(
    "change",
    [
        {"call_id": None},
        {"prompt_tokens": 0},
        {"prompt_tokens": None},
        {"latency_ms": -1},
        {"latency_ms": None},
        {"team": "legal"},
        {"team": None},
        {"model": "gpt-5"},
        {"model": None},
    ],
)
def test_rules_drop(spark, change):
    assert silver.api_calls(calls(spark, {}, change), prices(spark)).count() == 1


def test_padded_text_passes_and_case_is_kept(spark):
    got = silver.api_calls(
        calls(spark, {"team": " data ", "model": "gpt-4o  ", "status": " error ", "feature": " Chat "}),
        prices(spark, (" gpt-4o ", "0.005", "0.015", "p")),
    )
    assert rows(got, "team", "model", "feature", "is_error", "cost_usd") == [("data", "gpt-4o", "Chat", True, 0.0116)]


def test_unparsable_time_keeps_the_call(spark):
    got = silver.api_calls(calls(spark, {"timestamp": "soon"}, {}), prices(spark))
    assert set(rows(got, "event_date")) == {(date(2025, 11, 8),), (None,)}
    counted = {r["rule"]: (r["passed_records"], r["failed_records"]) for r in silver.call_rule_counts(calls(spark, {"timestamp": "soon"}, {})).collect()}
    assert counted["parsable_timestamp"] == (1, 1) and counted["all_rules"] == (2, 0)


def test_rule_counts_treat_unknown_as_failure(spark):
    counted = silver.call_rule_counts(calls(spark, {}, {"team": None, "latency_ms": None}))
    got = {r["rule"]: (r["passed_records"], r["failed_records"]) for r in counted.collect()}
    assert got["valid_team"] == got["valid_latency"] == got["all_rules"] == (1, 1)
    assert got["valid_call_id"] == (2, 0)


def test_duplicates_stay(spark):
    history, live = calls(spark, {}, {}), decode_calls(spark.createDataFrame([(bytearray(b'{"call_id": "c1"}'), None)], "value binary, timestamp timestamp"))
    assert silver.unify_calls(history, live).filter("call_id = 'c1'").count() == 3
    assert silver.unify_calls(history, None).columns == history.columns


def test_tokens_add_as_longs_and_null_propagates(spark):
    big = {"prompt_tokens": 2**31 - 1, "completion_tokens": 2**31 - 1}
    got = silver.api_calls(calls(spark, big, {"completion_tokens": None}), prices(spark))
    assert rows(got.orderBy(F.desc_nulls_last("total_tokens")), "total_tokens", "cost_usd") == [
        (2**32 - 2, 42949.67294),
        (None, None),
    ]


def test_flags_of_missing_values_are_false(spark):
    got = silver.clean_calls(calls(spark, {"latency_ms": None, "status": None}, {"latency_ms": 3000}, {"latency_ms": 3001}))
    assert rows(got, "is_slow", "is_error") == [(False, False), (False, False), (True, False)]


@pytest.mark.parametrize(
    ("prompt", "completion", "price", "wanted"),
    [(1, 0, "0.0005", 0.000001), (1, 0, "0.0004", 0.0), (3, 0, "0.00015", 0.0), (10, 0, "0.00015", 0.000002), (1, -2, "0.0010", -0.000001)],
)
def test_cost_rounds_half_away_from_zero(spark, prompt, completion, price, wanted):
    one = calls(spark, {"prompt_tokens": prompt, "completion_tokens": completion})
    got = silver.api_calls(one, prices(spark, ("gpt-4o", price, price, "p")))
    assert rows(got, "cost_usd") == [(wanted,)]


def test_missing_price_keeps_the_call_and_double_price_does_not_repeat_it(spark):
    two = calls(spark, {}, {"call_id": "c2", "model": "claude-3-sonnet"})
    listed = prices(spark, ("gpt-4o", "1", "1", "p"), (" gpt-4o ", "2", "2", "q"), ("gpt-4o", "nine", "9", "r"))
    got = silver.api_calls(two, listed)
    assert sorted(rows(got, "call_id", "cost_usd"), key=str) == [("c1", 3.28), ("c2", None)]
    assert rows(silver.duplicate_prices(listed), "model", "price_rows", "distinct_prices") == [("gpt-4o", 3, 3)]


def test_the_latest_price_counts(spark):
    old, new = (F.lit(day).cast("timestamp") for day in ("2025-01-01", "2025-02-01"))
    listed = prices(spark, ("gpt-4o", "5", "5", "p")).withColumn("ingested_at", old)
    listed = listed.unionByName(prices(spark, ("gpt-4o", "1", "1", "p")).withColumn("ingested_at", new))
    assert rows(silver.api_calls(calls(spark, {}), listed), "cost_usd") == [(1.64,)]


@pytest.mark.parametrize(
    ("prompt", "completion", "price", "wanted"),
    [
        (1_000_000, 0, "0.000000004", 0.000004),
        (2_000_000_000, 0, "0.0000000000004", 0.000001),
        (1_250_000, 0, "0.0000000000004", 0.0),
        (1, 0, "0.0005000000000001", 0.000001),
        (1, 0, "0.0004999999999999", 0.0),
        (0, -1, "0.0005000000000001", -0.000001),
        (0, -1, "0.0004999999999999", 0.0),
        (2_147_483_647, 0, "12.3456789012345678", 26512143.551514),
    ],
)
def test_no_place_of_a_price_is_lost(spark, prompt, completion, price, wanted):
    one = calls(spark, {"prompt_tokens": prompt, "completion_tokens": completion})
    got = silver.price_calls(silver.clean_calls(one), prices(spark, ("gpt-4o", price, price, "p")))
    assert rows(got, "cost_usd") == [(wanted,)]


def test_prices_that_cannot_be_read_are_counted(spark):
    listed = prices(spark, ("gpt-4o", "abc", "1", "p"), ("gpt-4o", "0.00000000000000001", "1", "p"), ("other", "1", None, "p"), (" gpt-4o", "1", "2", "p"))
    got = {r["rule"]: (r["passed_records"], r["failed_records"]) for r in silver.pricing_rule_counts(listed).collect()}
    assert got == {"valid_pricing_model": (3, 1), "readable_prices": (2, 2), "exact_prices": (1, 3), "all_rules": (3, 1)}
    kept = silver.model_pricing(listed).select("prompt_price_per_1k_tokens").collect()
    assert sorted(str(r[0]) for r in kept) == ["1.0", "1e-17", "None"]


def test_large_lookup_joins_by_salt(spark):
    facts = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (9, "z")], "k long, w string")
    small = lookup_join(facts, lookup, "k")
    salted = lookup_join(facts, lookup, "k", broadcast_rows=2, salts=5)
    assert sorted(rows(small, "k", "v", "w"), key=str) == sorted(rows(salted, "k", "v", "w"), key=str)
    assert small.count() == 500 + 167


def test_rules_run_before_the_join(spark, tmp_path, capsys):
    path = str(tmp_path / "calls")
    calls(spark, {}).write.parquet(path)
    silver.api_calls(spark.read.parquet(path), prices(spark)).explain("formatted")
    plan = capsys.readouterr().out
    for pushed in ("IsNotNull(call_id)", "GreaterThan(prompt_tokens,0)", "GreaterThanOrEqual(latency_ms,0)"):
        assert pushed in plan


def test_feedback_types(spark):
    raw = spark.createDataFrame(
        [("2026-01-01", " gpt-4o", "1"), ("soon", "gpt-4o", "0"), ("2026-01-01", "gpt-4o", "x"), ("2026-01-01", "m", "1"), ("2026-01-01", "gpt-4o", "2"),
         ("2026-01-02", "gpt-4o", "1.0"), ("2026-01-02", "gpt-4o", " 0"), ("2026-01-02", "gpt-4o", "0.5")],
        "date string, model string, thumbs_up string",
    )
    got = rows(silver.quality_feedback(raw), "feedback_date", "model", "thumbs_up", "thumbs_up_bool")
    later = date(2026, 1, 2)
    assert got == [
        (date(2026, 1, 1), "gpt-4o", 1, True), (None, "gpt-4o", 0, False), (later, "gpt-4o", 1, True), (later, "gpt-4o", 0, False),
    ]


def test_load_time_is_optional(spark):
    stamp = F.lit("2026-01-01").cast("timestamp")
    assert "silver_loaded_at" in silver.model_pricing(prices(spark), stamp).columns
    assert "silver_loaded_at" not in silver.model_pricing(prices(spark)).columns

"""Hand-made rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from callmeter.schemas import CALL_SCHEMA

CALL = {
    "call_id": "c1",
    "timestamp": "2025-11-08T04:59:37Z",
    "team": "ops",
    "feature": "ticket_router",
    "model": "gpt-4o",
    "environment": "staging",
    "prompt_tokens": 1300,
    "completion_tokens": 340,
    "latency_ms": 815,
    "status": "success",
    "status_code": 201,
    "user_id": "member-7",
}


def calls(spark: SparkSession, *changes: dict) -> DataFrame:
    """One call per argument, each with some fields changed."""
    rows = [tuple({**CALL, **change}[name] for name in CALL_SCHEMA.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, CALL_SCHEMA)


def prices(spark: SparkSession, *rows: tuple) -> DataFrame:
    rows = rows or (("gpt-4o", "0.005", "0.015", "p"), ("gpt-3.5-turbo", "0.0005", "0.0015", "p"))
    return spark.createDataFrame(
        list(rows),
        "model string, prompt_price_per_1k_tokens string, completion_price_per_1k_tokens string, provider string",
    )


def day(offset: int) -> date:
    return date(2026, 1, 1) + timedelta(days=offset)


def daily_cost(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows (day offset, team, total_cost_usd, total_calls, rolling mean)."""
    return spark.createDataFrame(
        [(day(d), team, float(cost), calls_, float(rolling)) for d, team, cost, calls_, rolling in rows],
        "event_date date, team string, total_cost_usd double, total_calls long, rolling_7d_avg_cost double",
    )

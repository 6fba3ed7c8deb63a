"""Input schemas, value domains and the table registry."""

from __future__ import annotations

from pyspark.sql import types as T

# The teams and models that the data-quality rules accept, and
# the integer codes under which the learners see them.
TEAM_CODES = {"product": 0, "data": 1, "marketing": 2, "ops": 3, "finance": 4}
MODEL_CODES = {"gpt-4o": 0, "claude-3-sonnet": 1, "gpt-3.5-turbo": 2}
TEAMS = tuple(TEAM_CODES)
MODELS = tuple(MODEL_CODES)

SLOW_AFTER_MS = 3000
ERROR_STATUS = "error"

# Decimal places: a cost per call, a daily total, a percentage.
CALL_COST_PLACES = 6
DAILY_COST_PLACES = 4
PERCENT_PLACES = 2
# Prices are held to 16 places per 1,000 tokens, in two longs of 8.
PRICE_PLACES = 16

# The fields of a call, of a price and of a feedback entry.
CALL_SCHEMA = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("prompt_tokens", T.IntegerType()),
        T.StructField("completion_tokens", T.IntegerType()),
        T.StructField("latency_ms", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("user_id", T.StringType()),
    ]
)

PRICING_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("prompt_price_per_1k_tokens", T.DecimalType(26, PRICE_PLACES)),
        T.StructField("completion_price_per_1k_tokens", T.DecimalType(26, PRICE_PLACES)),
        T.StructField("provider", T.StringType()),
    ]
)

FEEDBACK_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("thumbs_up", T.StringType()),
    ]
)

# Every table the jobs write, by layer.
TABLES = {
    "bronze": ("api_calls_historical", "api_calls_live", "model_pricing", "quality_feedback", "refused_files"),
    "silver": ("api_calls", "api_calls_refused", "model_pricing", "quality_feedback"),
    "gold": (
        "call_cube",
        "daily_users",
        "user_sketches",
        "daily_cost_by_team",
        "model_performance_summary",
        "feature_cost_breakdown",
        "quality_score_daily",
        "cost_predictions",
        "quality_alerts",
        "alert_summary",
        "alert_summary_forecast",
        "project_summary",
    ),
}

"""Call logs, feedback and addresses derived from the order tables.

There is no public data set of this shape; these views give every order line
the look of one API call, so that the jobs run on tables of any size.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.schemas import CALL_SCHEMA, PRICING_SCHEMA

# The published price list; providers are invented.
PRICES = (
    ("gpt-4o", "0.0050", "0.0150", "p1"),
    ("gpt-3.5-turbo", "0.0005", "0.0015", "p2"),
    ("claude-3-sonnet", "0.0030", "0.0150", "p3"),
)
SEGMENT_TEAMS = {
    "AUTOMOBILE": "product",
    "BUILDING": "data",
    "FURNITURE": "marketing",
    "HOUSEHOLD": "ops",
    "MACHINERY": "finance",
}
FLAG_MODELS = {"A": "gpt-4o", "N": "gpt-3.5-turbo", "R": "claude-3-sonnet"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _renamed(col: str, names: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(F.col(col) == old, F.lit(new)) for old, new in names.items()])


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean call per order line.

    What an order and its customer tell is worked out per order, and the lines
    are joined last.
    """
    read = partial(table, spark, sf_dir)
    orders = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T06:47:09Z")).alias("timestamp"),
        _renamed("c_mktsegment", SEGMENT_TEAMS).alias("team"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
    )
    joined = read("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    quantity = F.col("l_quantity").cast("int")
    failed = F.col("l_suppkey") % 25 == 0
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("call_id"),
        "timestamp",
        "team",
        F.concat(F.lit("feature_"), (F.col("l_partkey") % 10).cast("string")).alias("feature"),
        _renamed("l_returnflag", FLAG_MODELS).alias("model"),
        F.when(F.col("l_linestatus") == "F", "prod").otherwise("dev").alias("environment"),
        (quantity * 40).alias("prompt_tokens"),
        (quantity * 12).alias("completion_tokens"),
        ((F.col("l_partkey") % 40).cast("int") * 100).alias("latency_ms"),
        F.when(failed, "error").otherwise("success").alias("status"),
        F.when(failed, 500).otherwise(200).alias("status_code"),
        "user_id",
    )


def calls_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same calls with a defect for every rule, padded text, bad times and missing counts."""
    latency, prompt = F.col("latency_ms"), F.col("prompt_tokens")
    order = F.substring_index("call_id", "-", 1).cast("long")
    null = F.lit(None)
    few, fewer = prompt < 400, prompt < 200
    return calls(spark, sf_dir).withColumns(
        {
            "call_id": F.when(order % 101 == 0, null).otherwise(F.col("call_id")),
            "timestamp": F.when((latency == 3900) & (prompt == 2000), "not-a-time").otherwise(F.col("timestamp")),
            "team": F.when(latency == 100, F.concat(F.lit("  "), "team", F.lit(" ")))
            .when((latency == 200) & fewer, "unknown")
            .otherwise(F.col("team")),
            "model": F.when(latency == 300, F.concat("model", F.lit(" ")))
            .when((latency == 400) & fewer, "other-model")
            .when((latency == 500) & fewer, null)
            .otherwise(F.col("model")),
            "prompt_tokens": F.when((latency == 600) & few, 0).otherwise(prompt),
            "completion_tokens": F.when((latency == 700) & few, null).otherwise(F.col("completion_tokens")),
            "latency_ms": F.when((latency == 800) & few, -1).otherwise(latency),
        }
    )


def messages(calls_df: DataFrame) -> DataFrame:
    """Calls as broker messages (value, timestamp); those that took 900 ms are cut off and unreadable."""
    payload = F.to_json(F.struct(*CALL_SCHEMA.fieldNames()))
    broken = F.col("latency_ms") == 900
    return calls_df.select(
        F.when(broken, F.substring(payload, 1, 10)).otherwise(payload).cast("binary").alias("value"),
        F.timestamp_seconds(F.col("prompt_tokens").cast("long")).alias("timestamp"),
    )


def prices(spark: SparkSession) -> DataFrame:
    """The price list of the three models."""
    rows = ", ".join(map(str, PRICES))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS prices(model, p, q, provider)").select(
        "model",
        F.col("p").cast(PRICING_SCHEMA["prompt_price_per_1k_tokens"].dataType).alias("prompt_price_per_1k_tokens"),
        F.col("q")
        .cast(PRICING_SCHEMA["completion_price_per_1k_tokens"].dataType)
        .alias("completion_price_per_1k_tokens"),
        "provider",
    )


def prices_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price list as text: of each model an older row, a padded twin with many places, and an unreadable row.

    One model has only unreadable prices. The list grows with the parts, whose
    sizes give the last places.
    """
    model = F.when(F.col("p_partkey") % 3 == 0, "gpt-4o").when(F.col("p_partkey") % 3 == 1, "gpt-3.5-turbo").otherwise("claude-3-sonnet")
    kind = F.when(model == "claude-3-sonnet", F.lit(2)).otherwise((F.col("p_partkey") % 4).cast("int"))
    tail = F.lpad(F.col("p_size").cast("string"), 2, "0")
    price = F.when(kind == 0, F.concat(F.lit("0.00500000000"), tail)).when(kind == 2, "abc").otherwise("0.0001")
    return table(spark, sf_dir, "part").select(
        F.when(kind == 0, F.concat(F.lit(" "), model, F.lit(" "))).otherwise(model).alias("model"),
        price.alias("prompt_price_per_1k_tokens"),
        F.when(kind == 0, "0.0000000000004").otherwise("0.0002").alias("completion_price_per_1k_tokens"),
        F.timestamp_seconds(F.when(kind == 0, 2000).otherwise(F.when(kind == 2, 3000).otherwise(1000))).alias("ingested_at"),
        F.col("p_brand").alias("provider"),
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long price list as text, one row per part, with padded and unknown model names."""
    kind = F.col("p_partkey") % 4
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return table(spark, sf_dir, "part").select(
        F.when(kind == 0, " gpt-4o")
        .when(kind == 1, "gpt-3.5-turbo ")
        .when(kind == 2, "claude-3-sonnet")
        .otherwise("other-model")
        .alias("model"),
        price.cast("string").alias("prompt_price_per_1k_tokens"),
        (price * 2).cast("decimal(12,2)").cast("string").alias("completion_price_per_1k_tokens"),
        F.col("p_brand").alias("provider"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One thumbs up or down per event."""
    kind = F.col("event_id") % 3
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").cast("string").alias("date"),
        F.when(kind == 0, "gpt-4o").when(kind == 1, "gpt-3.5-turbo").otherwise("claude-3-sonnet").alias("model"),
        F.when(F.col("value") < 100, 1).otherwise(0).alias("thumbs_up"),
    )


def feedback_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feedback as text, with padded and unknown models, bad dates and bad thumbs."""
    user = F.col("user_id") % 20
    kind = F.col("event_id") % 3
    model = F.when(kind == 0, "gpt-4o").when(kind == 1, "gpt-3.5-turbo").otherwise("claude-3-sonnet")
    thumbs = F.when(F.col("value") < 100, "1").otherwise("0")
    thumbs = F.when(user == 5, F.concat(thumbs, F.lit(".0"))).when(user == 6, F.concat(F.lit(" "), thumbs)).otherwise(thumbs)
    return table(spark, sf_dir, "events").select(
        F.when(user == 4, "someday").otherwise(F.col("ts").cast("date").cast("string")).alias("date"),
        F.when(user == 0, F.concat(F.lit(" "), model)).when(user == 1, "other-model").otherwise(model).alias("model"),
        F.when(user == 2, "up").when(user == 3, "2").when(user == 7, "0.5").otherwise(thumbs).alias("thumbs_up"),
    )


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses, some of them malformed or missing."""
    kind = F.col("c_custkey") % 4
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(kind == 0, F.concat(F.lower("c_mktsegment"), F.lit("@example.com")))
        .when(kind == 1, F.concat("c_mktsegment", F.lit(" @example.com")))
        .when(kind == 2, F.col("c_mktsegment"))
        .alias("email"),
    )

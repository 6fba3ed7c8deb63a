"""Bronze to silver: clean, check against the rules, price every call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callmeter.functions.columns import stamped
from callmeter.functions.exact import drop_places, from_units
from callmeter.operators import rules
from callmeter.operators.joins import lookup_join
from callmeter.schemas import CALL_COST_PLACES, ERROR_STATUS, PRICE_PLACES, SLOW_AFTER_MS

CALL_TEXT = ("team", "model", "feature", "environment", "status")


def unify_calls(historical: DataFrame, live: DataFrame | None) -> DataFrame:
    """History and live calls by column name; duplicates stay."""
    return historical if live is None else historical.unionByName(live, allowMissingColumns=True)


def clean_calls(calls: DataFrame) -> DataFrame:
    """Trimmed text, parsed time and the derived flags; drops nothing.

    A time that does not parse becomes NULL, and so does the date. Token
    counts are added as longs.
    """
    trimmed = calls.withColumns(
        {
            **{name: F.trim(name) for name in CALL_TEXT},
            "event_timestamp": F.try_to_timestamp("timestamp"),
        }
    )
    return trimmed.withColumns(
        {
            "event_date": F.col("event_timestamp").cast("date"),
            "total_tokens": F.col("prompt_tokens").cast("long") + F.col("completion_tokens").cast("long"),
            "is_slow": F.coalesce(F.col("latency_ms") > SLOW_AFTER_MS, F.lit(False)),
            "is_error": F.coalesce(F.col("status") == ERROR_STATUS, F.lit(False)),
        }
    ).drop("timestamp", "ingested_at")


PRICES = ("prompt_price_per_1k_tokens", "completion_price_per_1k_tokens")
_HALF = 10 ** (PRICE_PLACES // 2)


def _readable(col: str) -> Column:
    """A price as an exact decimal; NULL if it cannot be read."""
    return F.col(col).try_cast(f"decimal(26,{PRICE_PLACES})")


def _exact(col: str) -> Column:
    """Whether no place of a price is lost; NULL if it cannot be read."""
    return F.col(col).try_cast("decimal(38,28)") == _readable(col)


def _price_units(col: str, name: str) -> list[Column]:
    """A price in whole units of 10^-8, and the rest of it in units of 10^-16."""
    units = _readable(col) * F.lit(_HALF)
    rest = units % F.lit(1) * F.lit(_HALF)
    return [units.cast("long").alias(name), rest.cast("long").alias(f"{name}_rest")]


def current_prices(pricing: DataFrame) -> DataFrame:
    """One row per trimmed model: the price list's latest row, by ``ingested_at`` where it has one.

    Rows with both prices readable come before others, and of rows equally
    late the one with the greatest prices is taken, so that spend is not
    understated.
    """
    late = F.col("ingested_at") if "ingested_at" in pricing.columns else F.lit(None).cast("timestamp")
    prices = [_readable(p).alias(p) for p in PRICES]
    order = F.struct(
        (_readable(PRICES[0]).isNotNull() & _readable(PRICES[1]).isNotNull()).alias("readable"), late.alias("late"), *prices
    )
    rows = pricing.select(F.trim("model").alias("model"), F.struct(order.alias("order"), *prices).alias("row"))
    latest = rows.groupBy("model").agg(F.max("row").alias("row"))
    return latest.select("model", *[F.col(f"row.{p}").alias(p) for p in PRICES])


def duplicate_prices(pricing: DataFrame) -> DataFrame:
    """Models that the price list names more than once, with their rows and their distinct prices."""
    prices = F.struct(*[_readable(p).alias(p) for p in PRICES])
    return (
        pricing.groupBy(F.trim("model").alias("model"))
        .agg(F.count(F.lit(1)).alias("price_rows"), F.count_distinct(prices).alias("distinct_prices"))
        .filter("price_rows > 1")
    )


def price_calls(calls: DataFrame, pricing: DataFrame) -> DataFrame:
    """Add ``cost_usd``, rounded to six places per call.

    Calls of a model without a readable price keep a NULL cost. A model that
    the list names more than once has the price of ``current_prices``, so no
    call is repeated. Prices are per 1,000 tokens, so the product has three
    places more. It is worked out in longs, the places beyond the eighth apart;
    one call of more than 92 million dollars would raise an overflow error.
    """
    rates = current_prices(pricing).select(
        "model", *_price_units(PRICES[0], "_prompt_rate"), *_price_units(PRICES[1], "_completion_rate")
    )
    prompt, completion = F.col("prompt_tokens").cast("long"), F.col("completion_tokens").cast("long")

    def product(part: str) -> Column:
        return prompt * F.col(f"_prompt_rate{part}") + completion * F.col(f"_completion_rate{part}")

    step = F.lit(_HALF).cast("long")
    priced = lookup_join(calls, rates, "model").withColumns({"_cost": product(""), "_rest": product("_rest")})
    priced = priced.withColumn("_left", F.pmod("_rest", step))
    priced = priced.withColumn("_cost", F.col("_cost") + F.call_function("div", F.col("_rest") - F.col("_left"), step))
    # Rounding needs the product cut towards zero: a negative one with a rest is taken one unit nearer to it.
    priced = priced.withColumn("_cost", F.col("_cost") + ((F.col("_cost") < 0) & (F.col("_left") > 0)).cast("long"))
    units = drop_places(F.col("_cost"), PRICE_PLACES // 2 + 3, CALL_COST_PLACES)
    return priced.select(*calls.columns, from_units(units, CALL_COST_PLACES).alias("cost_usd"))


def api_calls(
    historical: DataFrame,
    pricing: DataFrame,
    live: DataFrame | None = None,
    loaded_at: Column | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Silver calls. The rules look at call columns only, so they run before the join.

    An ``observation`` receives the rule counts of the action that reads the
    result; without one, the rules on plain columns reach the scan.
    """
    cleaned = clean_calls(unify_calls(historical, live))
    counted = rules.observed(cleaned, rules.call_rules(), observation, _reported())
    priced = price_calls(rules.keep(counted, rules.call_rules()), pricing)
    return stamped(priced, "silver_loaded_at", loaded_at)


def marked_calls(
    historical: DataFrame, pricing: DataFrame, live: DataFrame | None = None, loaded_at: Column | None = None
) -> DataFrame:
    """All calls, cleaned and priced, with the rules they fail (``failed_rules``) and whether they are ``refused``."""
    found = rules.marked(clean_calls(unify_calls(historical, live)), rules.call_rules(), _reported())
    return stamped(price_calls(found, pricing), "silver_loaded_at", loaded_at)


def marked_counts(stored: DataFrame) -> dict[str, int]:
    """Records and failures by rule of stored ``marked_calls``."""
    return rules.failure_counts(stored, rules.call_rules(), _reported())


def refused_calls(historical: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """The cleaned calls that a rule refuses, with the bits of the rules they fail."""
    found = rules.marked(clean_calls(unify_calls(historical, live)), rules.call_rules(), _reported())
    return found.filter("refused").drop("refused")


def _reported() -> dict[str, Column]:
    """Conditions that are counted but drop nothing."""
    return {"parsable_timestamp": F.col("event_timestamp").isNotNull()}


def call_rule_counts(historical: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """Pass and fail counts of the call rules, and of times that do not parse."""
    cleaned = clean_calls(unify_calls(historical, live))
    return rules.counts(cleaned, rules.call_rules(), _reported())


def _whole_number(col: str) -> Column:
    """An integer however it is written, ``1`` or `` 1.0``; NULL for anything else."""
    number = F.col(col).try_cast("double")
    return F.when(number == F.rint(number), number.try_cast("int"))


def clean_feedback(feedback: DataFrame) -> DataFrame:
    """Typed feedback; values that are no date or no number become NULL. Drops nothing."""
    return (
        feedback.withColumns(
            {
                "feedback_date": F.col("date").try_cast("date"),
                "model": F.trim("model"),
                "thumbs_up": _whole_number("thumbs_up"),
            }
        )
        .withColumn("thumbs_up_bool", F.coalesce(F.col("thumbs_up") == 1, F.lit(False)))
        .drop("date", "ingested_at")
    )


def quality_feedback(
    feedback: DataFrame, loaded_at: Column | None = None, observation: Observation | None = None
) -> DataFrame:
    """Silver feedback."""
    counted = rules.observed(clean_feedback(feedback), rules.feedback_rules(), observation)
    return stamped(rules.keep(counted, rules.feedback_rules()), "silver_loaded_at", loaded_at)


def feedback_rule_counts(feedback: DataFrame) -> DataFrame:
    return rules.counts(clean_feedback(feedback), rules.feedback_rules())


def clean_pricing(pricing: DataFrame) -> DataFrame:
    """Price list with trimmed names and prices as doubles; unreadable prices become NULL. Drops nothing."""
    return pricing.withColumns(
        {"model": F.trim("model"), **{price: F.col(price).try_cast("double") for price in PRICES}}
    ).drop("ingested_at")


def model_pricing(
    pricing: DataFrame, loaded_at: Column | None = None, observation: Observation | None = None
) -> DataFrame:
    """Silver price list."""
    counted = rules.observed(clean_pricing(pricing), rules.pricing_rules(), observation)
    return stamped(rules.keep(counted, rules.pricing_rules()), "silver_loaded_at", loaded_at)


def pricing_rule_counts(pricing: DataFrame) -> DataFrame:
    """Pass and fail counts, with prices that cannot be read or have more places than are kept."""
    readable = _readable(PRICES[0]).isNotNull() & _readable(PRICES[1]).isNotNull()
    marked = pricing.select("model", readable.alias("_readable"), (_exact(PRICES[0]) & _exact(PRICES[1])).alias("_exact"))
    reported = {"readable_prices": F.col("_readable"), "exact_prices": F.col("_exact")}
    return rules.counts(marked.withColumn("model", F.trim("model")), rules.pricing_rules(), reported)

"""Named data-quality rules: keep what passes, count what fails."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callmeter.schemas import MODELS, TEAMS

Rules = Mapping[str, Column]


# Names and conditions of the rules.


def call_rules() -> dict[str, Column]:
    return {
        "valid_call_id": F.col("call_id").isNotNull(),
        "valid_tokens": F.col("prompt_tokens") > 0,
        "valid_latency": F.col("latency_ms") >= 0,
        "valid_team": F.col("team").isin(*TEAMS),
        "valid_model": F.col("model").isin(*MODELS),
    }


def feedback_rules() -> dict[str, Column]:
    return {
        "valid_feedback_model": F.col("model").isin(*MODELS),
        "valid_thumbs": F.col("thumbs_up").isin(0, 1),
    }


def pricing_rules() -> dict[str, Column]:
    return {"valid_pricing_model": F.col("model").isin(*MODELS)}


def keep(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that pass every rule; an unknown (NULL) outcome does not pass."""
    return df.filter(reduce(Column.__and__, rules.values()))


def _passing(rules: Rules, reported: Rules | None) -> dict[str, Column]:
    """Each rule's outcome with unknown as failure, and ``all_rules`` for the records kept."""
    known = {name: F.coalesce(cond, F.lit(False)) for name, cond in {**rules, **(reported or {})}.items()}
    return {**known, "all_rules": reduce(Column.__and__, [known[name] for name in rules])}


def failed(rules: Rules, reported: Rules | None = None) -> Column:
    """The rules that a row fails, and the reported conditions, as bits of an int in their order; unknown is failure."""
    known = _passing(rules, reported)
    bits = [F.when(~known[name], F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(known) if name != "all_rules"]
    return reduce(Column.bitwiseOR, bits)


def marked(df: DataFrame, rules: Rules, reported: Rules | None = None) -> DataFrame:
    """All rows, with ``failed_rules`` and whether a rule refuses them; reported conditions refuse none."""
    some = F.col("failed_rules").bitwiseAND((1 << len(rules)) - 1) != 0
    return df.withColumn("failed_rules", failed(rules, reported)).withColumn("refused", some)


def failure_counts(stored: DataFrame, rules: Rules, reported: Rules | None = None) -> dict[str, int]:
    """Records and, by rule, how many failed, of rows that ``marked`` has given their bits.

    Taken from stored rows it counts what was committed, however often tasks
    ran. Only the masks that occur reach the driver.
    """
    masks = {r["failed_rules"]: r["count"] for r in stored.groupBy("failed_rules").count().collect()}
    names = [*rules, *(reported or {})]
    found = {name: sum(n for mask, n in masks.items() if mask >> i & 1) for i, name in enumerate(names)}
    refused = sum(n for mask, n in masks.items() if mask & (1 << len(rules)) - 1)
    return {"records": sum(masks.values()), **found, "all_rules": refused}


def observed(df: DataFrame, rules: Rules, observation: Observation | None, reported: Rules | None = None) -> DataFrame:
    """Count failures per rule while some later action reads ``df``, without another pass.

    After the action ``observation.get`` holds the number of records and, by
    rule, how many of them failed.
    """
    if observation is None:
        return df
    failing = [F.count_if(~cond).alias(name) for name, cond in _passing(rules, reported).items()]
    return df.observe(observation, F.count(F.lit(1)).alias("records"), *failing)


def counts(df: DataFrame, rules: Rules, reported: Rules | None = None) -> DataFrame:
    """One row (rule, passed_records, failed_records) per rule, in one pass.

    ``reported`` holds conditions that are counted but never drop a row. The
    row ``all_rules`` counts the records kept and dropped.
    """
    known = _passing(rules, reported)
    totals = df.agg(
        F.count(F.lit(1)).alias("_records"),
        *[F.count_if(cond).alias(name) for name, cond in known.items()],
    )
    return totals.unpivot(["_records"], list(known), "rule", "passed_records").select(
        "rule", "passed_records", (F.col("_records") - F.col("passed_records")).alias("failed_records")
    )

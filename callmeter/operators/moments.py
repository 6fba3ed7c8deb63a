"""Means and deviations that can be kept per batch and merged, so that new days need no history.

A partial row holds count, mean and m2 (the sum of squared distances from the
mean) of some rows. Two of them merge by the pairwise update of Chan, Golub and
LeVeque (1979), which loses no digits to cancellation as sums of squares do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("n", "mean", "m2")


def _name(col: str, field: str) -> str:
    return f"{col}_{field}"


def partial_moments(df: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """Per key the moments of each column; NULLs do not count. A column without values has n 0, mean and m2 0."""
    out = []
    for c in columns:
        value = F.col(c).cast("double")
        n = F.count(value)
        out += [
            n.alias(_name(c, "n")),
            F.coalesce(F.avg(value), F.lit(0.0)).alias(_name(c, "mean")),
            F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias(_name(c, "m2")),
        ]
    return df.groupBy(*keys).agg(*out)


def _merged(parts: Column) -> Column:
    """One struct (n, mean, m2) from an array of them."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def update(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        share = F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * share).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
        )

    return F.aggregate(parts, start, update)


def merge_moments(parts: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """One row per key from its partial rows, in an order that does not depend on where they come from.

    A key has as many partial rows as there are batches, however many rows are behind them.
    """
    arrays = [
        F.sort_array(F.collect_list(F.struct(*[F.col(_name(c, f)).alias(f) for f in FIELDS]))).alias(c) for c in columns
    ]
    # A lambda variable holds each merged struct, so that it is worked out once for its three fields.
    merged = parts.groupBy(*keys).agg(*arrays).select(*keys, *[_merged(F.col(c)).alias(c) for c in columns])
    return merged.select(*keys, *[F.col(f"{c}.{f}").alias(_name(c, f)) for c in columns for f in FIELDS])


def mean_of(col: str) -> Column:
    return F.when(F.col(_name(col, "n")) > 0, F.col(_name(col, "mean")))


def sample_deviation(col: str) -> Column:
    """NULL for fewer than two values."""
    return F.when(F.col(_name(col, "n")) > 1, F.sqrt(F.col(_name(col, "m2")) / (F.col(_name(col, "n")) - 1)))


def population_deviation(col: str) -> Column:
    return F.when(F.col(_name(col, "n")) > 0, F.sqrt(F.col(_name(col, "m2")) / F.col(_name(col, "n"))))

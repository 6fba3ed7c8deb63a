"""Merged moments and quantiles of many columns against plain sums and sorts."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from callmeter.operators.moments import mean_of, merge_moments, partial_moments, population_deviation, sample_deviation
from callmeter.operators.quantile import exact_quantiles


def test_merged_moments_equal_those_of_all_rows(spark):
    rng = random.Random(1)
    rows = [(k, 1e9 + rng.gauss(0, 1), rng.choice([None, rng.random()])) for k in ("a", "b", None) for _ in range(200)]
    rows += [("one", 5.0, None)]
    df = spark.createDataFrame(rows, "key string, x double, y double").repartition(5)
    batches = [df.filter(F.pmod(F.xxhash64("x"), F.lit(4)) == k) for k in range(4)]
    parts = [partial_moments(b, ("x", "y"), "key") for b in batches]
    merged = merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), ("x", "y"), "key")
    found = merged.select("key", *[f(c).alias(f"{f.__name__}_{c}") for c in "xy" for f in (mean_of, sample_deviation, population_deviation)])
    for r in found.collect():
        for i, c in enumerate("xy", start=1):
            values = [row[i] for row in rows if row[0] == r["key"] and row[i] is not None]
            assert r[f"mean_of_{c}"] == (pytest.approx(statistics.fmean(values), rel=1e-12) if values else None)
            deviation = statistics.stdev(values) if len(values) > 1 else None
            assert r[f"sample_deviation_{c}"] == (pytest.approx(deviation, rel=1e-6) if deviation is not None else None)
            whole = statistics.pstdev(values) if values else None
            assert r[f"population_deviation_{c}"] == (pytest.approx(whole, rel=1e-6) if whole is not None else None)
    assert merge_moments(partial_moments(df.limit(0), ("x",), "key"), ("x",), "key").isEmpty()


def test_quantiles_of_many_keys(spark):
    rng = random.Random(2)
    rows = [("ties", float(rng.randrange(3))) for _ in range(501)] + [("spread", rng.random()) for _ in range(1000)]
    rows += [("one", 7.0), ("two", 1.0), ("two", 2.0), ("spread", None), ("none", None)]
    df = spark.createDataFrame(rows, "name string, value double").repartition(6)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {(r["key"], r["share"]): r["quantile"] for r in exact_quantiles(df, "name", "value", shares).collect()}
    expected = df.groupBy("name").agg(F.percentile("value", F.array(*map(F.lit, shares))).alias("q")).filter("q IS NOT NULL").collect()
    assert found == pytest.approx({(r["name"], share): q for r in expected for share, q in zip(shares, r["q"], strict=True)})
    assert exact_quantiles(df.limit(0), "name", "value", shares).isEmpty()

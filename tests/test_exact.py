from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callmeter.functions.exact import divide_half_up, drop_places, from_units, percent, round_places, to_units


def rounded(value: Decimal, places: int) -> Decimal:
    return value.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**62), 2**62), st.integers(0, 2**40)), min_size=1, max_size=60))
def test_divide_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "num long, den long")
    got = df.select("num", "den", divide_half_up(F.col("num"), F.col("den")).alias("q")).collect()
    for num, den, q in got:
        wanted = None if den == 0 else (2 * abs(num) + den) // (2 * den) * (1 if num >= 0 else -1)
        assert q == wanted, (num, den)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=60), st.integers(0, 5))
def test_drop_places(spark, values, digits):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for v, got in df.select("v", drop_places(F.col("v"), digits, 0)).collect():
        assert got == int(rounded(Decimal(v).scaleb(-digits), 0)), v


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(10**14), 10**14), min_size=1, max_size=60))
def test_units_survive_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long").withColumn("d", from_units("v", 6))
    assert all(v == back for v, back in df.select("v", to_units("d", 6)).collect())


@pytest.mark.parametrize(
    ("value", "places", "wanted"),
    [(85.2325, 3, 85.233), (0.285, 2, 0.29), (-0.5, 0, -1.0), (2.675, 2, 2.68), (1e-7, 6, 0.0)],
)
def test_round_places(spark, value, places, wanted):
    assert spark.range(1).select(round_places(F.lit(value), places)).first()[0] == wanted


def test_percent(spark):
    cases = spark.createDataFrame([(1, 3), (2, 3), (1, 800), (0, 0)], "p long, w long")
    got = [row[0] for row in cases.select(percent(F.col("p"), F.col("w"))).collect()]
    assert got == [33.33, 66.67, 0.13, None]

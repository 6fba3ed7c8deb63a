"""The isolation forest against plain numpy, and its sampling."""

from __future__ import annotations

import math
import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from callmeter.operators import forest
from callmeter.operators.quantile import exact_quantile
from conftest import ROOT

COLUMNS = ("a", "b")


@pytest.fixture(scope="module")
def points(spark):
    """300 rows around the origin, five far out."""
    rng = np.random.default_rng(7)
    near = rng.normal(0, 1, (300, 2))
    far = np.array([[9, 9], [-9, 9], [9, -9], [-9, -9], [0, 12]], dtype=float)
    table = pd.DataFrame(np.vstack([near, far]), columns=COLUMNS)
    table.insert(0, "id", range(len(table)))
    return spark.createDataFrame(table).cache()


@pytest.fixture(scope="module")
def grown(points):
    return forest.fit(points, COLUMNS, ("id",), trees=50, sample=64, seed=3)


def walk(f: forest.IsolationForest, tree: int, point) -> float:
    node = 0
    n = f.nodes
    while n["feature"][tree, node] >= 0:
        left = point[n["feature"][tree, node]] <= n["threshold"][tree, node]
        node = (n["left"] if left else n["right"])[tree, node]
    return n["path"][tree, node]


def test_mean_path():
    assert forest.mean_path(1)[0] == 0 and forest.mean_path(2)[0] == 1
    assert np.isclose(forest.mean_path(256)[0], 2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_scores_equal_a_walk_through_every_tree(points, grown):
    got = points.withColumn("s", grown.score_column(points)).toPandas()
    for row in got.itertuples():
        depth = np.mean([walk(grown, t, (row.a, row.b)) for t in range(50)])
        assert np.isclose(row.s, -(2 ** (-depth / forest.mean_path(64)[0])))


def test_trees_equal_those_grown_on_the_same_rows(points, grown):
    offered = forest.draw_samples(points, COLUMNS, ("id",), 50, 64, 3).toPandas()
    for tree, rows in offered.groupby("tree"):
        kept = rows.sort_values(["_order", "_tie"]).head(64)
        nodes = forest.grow(kept[["x0", "x1"]].to_numpy(), np.random.default_rng([3, tree]), 6)
        assert len(kept) == 64
        assert [n[0] for n in nodes] == list(grown.nodes["feature"][tree][: len(nodes)])
        assert np.allclose([n[4] for n in nodes], grown.nodes["path"][tree][: len(nodes)])


def test_leaves_hold_every_sampled_point():
    rows = np.random.default_rng(0).normal(size=(100, 3))
    nodes = forest.grow(rows, np.random.default_rng(1), 7)
    inner = [n for n in nodes if n[0] >= 0]
    assert len(nodes) == 2 * len(inner) + 1
    same = forest.grow(np.ones((10, 2)), np.random.default_rng(1), 7)
    assert len(same) == 1 and np.isclose(same[0][4], forest.mean_path(10)[0])


def test_finds_planted_outliers(points, grown):
    scored = points.withColumn("score", grown.score_column(points))
    flagged = forest.flag_share(scored, "score", "flag", 0.05)
    assert {300, 301, 302, 303, 304} <= {r.id for r in flagged.filter("flag = 1").collect()}
    scores = scored.toPandas()["score"]
    assert flagged.agg(F.sum("flag")).first()[0] == int((scores < np.percentile(scores, 5)).sum()) == 16


def test_same_seed_same_forest(points, grown):
    shuffled = points.repartition(7)
    again = forest.fit(shuffled, COLUMNS, ("id",), trees=50, sample=64, seed=3)
    other = forest.fit(points, COLUMNS, ("id",), trees=50, sample=64, seed=4)
    assert np.array_equal(again.nodes["threshold"], grown.nodes["threshold"])
    assert not np.array_equal(other.nodes["threshold"], grown.nodes["threshold"])


@pytest.mark.parametrize("rows", [700, 1100, 20_000])
def test_every_tree_draws_from_all_rows(spark, rows):
    """By one rule, for fewer and more rows than all trees take together."""
    table = spark.range(rows).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    drawn = forest.draw_samples(table, COLUMNS, ("id",), 10, 100, 1)
    share = min(1.0, 400 / rows)
    for tree in range(10):
        own = table.filter(forest._fraction("id", F.lit(tree), F.lit(1)) < share).count()
        assert drawn.filter(F.col("tree") == tree).count() == own
    assert drawn.select("_tie").distinct().count() > min(0.95 * rows, 3_400)


def test_large_table(spark):
    table = spark.range(20_000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    offered = forest.draw_samples(table, COLUMNS, ("id",), 10, 100, 1).groupBy("tree").count().toPandas()
    assert len(offered) == 10 and offered["count"].between(100, 700).all()
    grown = forest.fit(table, COLUMNS, ("id",), trees=10, sample=100, seed=1)
    assert grown.sample == 100


def test_fewer_rows_than_the_sample(spark):
    few = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 9.0, 9.0)], "id long, a double, b double")
    grown = forest.fit(few, COLUMNS, ("id",), trees=20)
    assert grown.sample == 3
    assert few.withColumn("s", grown.score_column(few)).orderBy("s").first().id == 3


@pytest.mark.parametrize("share", [0.0, 0.05, 0.5, 0.999, 1.0])
def test_exact_quantile(spark, share):
    rng = np.random.default_rng(9)
    values = np.round(rng.normal(size=3001), 2)
    table = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(7)
    assert exact_quantile(table, "x", share) == pytest.approx(np.quantile(values, share), abs=1e-12)


def test_quantile_of_few_values(spark):
    assert exact_quantile(spark.createDataFrame([], "x double"), "x", 0.5) is None
    assert exact_quantile(spark.createDataFrame([(2.0,)], "x double"), "x", 0.5) == 2.0
    assert exact_quantile(spark.createDataFrame([(7.0,)] * 50, "x double"), "x", 0.05) == 7.0


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no rows"):
        forest.fit(spark.createDataFrame([], "id long, a double, b double"), COLUMNS, ("id",))


def test_save_and_load(spark, points, grown, tmp_path):
    forest.save(grown, spark, str(tmp_path / "forest"))
    back = forest.load(spark, str(tmp_path / "forest"))
    sample = np.array([[0.1, 0.2], [8.0, 8.0]])
    assert back.columns == grown.columns and np.array_equal(back.scores(sample), grown.scores(sample))


def test_tasks_do_not_need_the_package(tmp_path):
    """Python tasks of a session whose workers cannot import the package."""
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from callmeter.operators import forest
from callmeter.operators.quantile import exact_quantile
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.range(50).selectExpr("id", "double(id) a", "double(id * id) b")
grown = forest.fit(df, ("a", "b"), ("id",), trees=5)
print("scored", df.withColumn("s", grown.score_column(df)).where("s < 0").count())
"""
    elsewhere = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300, env=elsewhere
    )
    assert "scored 50" in done.stdout, done.stderr[-2000:]

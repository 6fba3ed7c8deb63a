"""Versions of models and of tables whose schema changes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from builders import daily_cost
from callmeter.operators import forest
from callmeter.plans import features, forecast
from callmeter.sources.lake import Lake, merged_schema, wider_type


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(d, team, 5 + (d % 7) + len(team), 10 + d, 5 + d % 3) for d in range(80) for team in ("ops", "data")]
    return forecast.train(features.cost_features(daily_cost(spark, *rows)), maxIter=2)


@pytest.fixture(scope="module")
def grown(spark):
    points = spark.range(300).select("id", F.rand(3).alias("x"), F.rand(4).alias("y"))
    return forest.fit(points, ("x", "y"), ("id",), trees=5, sample=32)


def test_versions_of_a_model(spark, trained, grown, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    assert forecast.versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        forecast.load(spark, path)
    assert forecast.save(trained, path) == 1
    trained.forest = grown
    assert forecast.save(trained, path) == 2
    back, first = forecast.load(spark, path), forecast.load(spark, path, 1)
    assert first.forest is None and back.forest.columns == ("x", "y")
    assert all((back.forest.nodes[name] == array).all() for name, array in grown.nodes.items())
    assert back.settings == trained.settings and back.sample.collect() == trained.sample.collect()
    told = spark.read.parquet(f"{path}/v2/training").first()
    assert T.StructType.fromJson(__import__("json").loads(told["input_schema"])) == trained.sample.schema

    # A version that breaks off before its last write is none, and is written anew.
    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(forest, "save", broken)
        with pytest.raises(OSError, match="disk full"):
            forecast.save(trained, path)
    assert forecast.versions(spark, path) == [1, 2]
    assert forecast.load(spark, path).metrics.collect() == back.metrics.collect()
    with pytest.raises(FileNotFoundError):
        forecast.load(spark, path, 3)
    assert forecast.save(trained, path) == 3 and forecast.versions(spark, path) == [1, 2, 3]


def test_a_table_whose_schema_changes(spark):
    lake = Lake(spark, "evolves_", keep_versions=3)
    lake.create()
    first = spark.createDataFrame([(1, "it's", 1)], "id int, name string, day int")
    lake.materialize(first.select("id", "name"), "gold", "alert_summary", merge_schema=True)
    second = spark.createDataFrame([(2**40, 2.5)], "id long, cost double")
    lake.materialize(second, "gold", "alert_summary", merge_schema=True)
    third = spark.createDataFrame([(3, 4, "x")], "id int, cost int, name string")
    stored = lake.materialize(third, "gold", "alert_summary", merge_schema=True)
    assert stored.schema.simpleString() == "struct<id:bigint,name:string,cost:double>"
    assert [tuple(r) for r in stored.collect()] == [(3, "x", 4.0)]
    history = lake.schema_history("gold", "alert_summary")
    assert [(n, s.simpleString()) for n, s in history] == [
        (1, "struct<id:int,name:string>"),
        (2, "struct<id:bigint,name:string,cost:double>"),
        (3, "struct<id:bigint,name:string,cost:double>"),
    ]
    assert [tuple(r) for r in lake.as_of("gold", "alert_summary", 1).collect()] == [(1, "it's", None)]
    assert [tuple(r) for r in lake.as_of("gold", "alert_summary", 2).collect()] == [(2**40, None, 2.5)]
    with pytest.raises(ValueError, match="name: string and int"):
        lake.materialize(spark.createDataFrame([(5,)], "name int"), "gold", "alert_summary", merge_schema=True)
    assert lake.load("gold", "alert_summary").count() == 1
    # Without merging the table takes the new schema as it is.
    plain = lake.materialize(spark.createDataFrame([(5,)], "name int"), "gold", "alert_summary")
    assert plain.schema.simpleString() == "struct<name:int>"


@pytest.mark.parametrize(
    ("a", "b", "wide"),
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "int", "double"), ("float", "smallint", "float"),
        ("date", "timestamp", "timestamp"), ("decimal(5,2)", "decimal(8,4)", "decimal(8,4)"), ("string", "string", "string"),
        ("string", "int", None), ("boolean", "int", None), ("decimal(38,0)", "decimal(38,10)", None),
    ],
)
def test_wider_types(spark, a, b, wide):
    kinds = [T.StructType.fromDDL(f"x {k}") for k in (a, b)]
    for x, y in (kinds, kinds[::-1]):
        if wide is None:
            with pytest.raises(ValueError):
                merged_schema(x, y)
        else:
            assert wider_type("x", x[0].dataType, y[0].dataType).simpleString() == wide

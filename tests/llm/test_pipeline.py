"""The pipeline's stages, each on the rows that the one before kept."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from callmeter.llm import registry
from check_oracles import connect, difference
from tests.llm.cases import clashing, documents


def test_registered():
    names = set(registered.queries())
    assert set(registry.QUERIES) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in registry.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, sf_dir, name):
    result = registry.QUERIES[name](spark, sf_dir).toArrow()
    assert difference(result, connect(sf_dir).sql(registry.ORACLE_SQL[name]).to_arrow_table()) is None


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        result = spark.read.parquet(f"{tmp_path}/{name}")
        kept = {r["doc_id"] for r in result.select("doc_id").distinct().collect()}
        if name == "packing":
            assert kept == before
            continue
        assert result.columns == columns and result.count() == len(kept) and kept <= before
        assert result.exceptAll(docs).isEmpty()
        assert len(kept) > 0.75 * len(before)
        if name == "quality":
            bad = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 0").collect()
            assert not kept & {r["doc_id"] for r in bad}
        docs, before = result, kept
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in whole} == before
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in whole) == sorted(
        (r["doc_id"], r["start"], r["ids_crc32"]) for r in result.collect()
    )


def test_stages_take_awkward_rows(spark, sf_dir):
    docs = clashing(documents(spark))
    for _, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            stage(spark, rows, sf_dir).collect()

"""Quality and language on held-out rows of the given tables, and on awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from callmeter.llm import langid, linear, quality, registry
from tests.llm.cases import SCHEMA, awkward_rows, clashing, documents, sorted_rows

SF = "/root/testdata/sf0.01"


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_quality_on_held_out_labels(spark):
    found = registry.QUERIES["op5_quality_classifier"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(found) == docs.count()
    assert all(found["held_out"] == [remainder(i, 3) == 1 for i in found.index])
    assert found["score"].between(0, 1).all() and all(found["predicted"] == (found["score"] >= 0.5))
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    held = found[found["held_out"] & found.index.isin(labels.index)]
    truth = labels[held.index]
    assert (held["predicted"] == truth).mean() > 0.97
    assert held[truth == 1]["predicted"].mean() > 0.97


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 0).otherwise(F.col("quality")))
    a, b = (quality.fit_quality(docs, x, quality.learnable()) for x in (labels, flipped))
    assert np.array_equal(a, b)


def test_quality_of_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (7, 1, 0), (8, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    found = quality.quality_scores(clashing(docs), clashing(labels))
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert len(empty) == 1
    assert quality.keep_quality(clashing(docs), labels).columns == clashing(docs).columns


@pytest.mark.parametrize("labelled", [False, True])
def test_quality_of_empty_tables(spark, labelled):
    docs, labels = documents(spark, [] if labelled else None), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(docs, labels).collect()
    assert {r["score"] for r in rows} <= {0.5} and len(rows) == docs.count()


def test_language_on_held_out_documents(spark):
    found = registry.QUERIES["op6_language_id"](spark, SF).toPandas().set_index("doc_id")
    langs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")["lang"]
    assert len(found) == len(langs) and all(found["held_out"] == [remainder(i, 4) == 2 for i in found.index])
    held = found[found["held_out"]]
    assert (held["lang_pred"] == langs[held.index]).mean() > 0.97
    assert found["score"].between(0, 1).all()


def test_language_of_awkward_rows(spark):
    found = langid.language_scores(clashing(documents(spark)))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (2, 3, 4, 6))
    assert by_id[7]["lang_pred"] in ("en", "de", "fr")
    kept = langid.keep_identified(clashing(documents(spark)))
    assert kept.columns == clashing(documents(spark)).columns
    assert not {2, 3, 4, 6} & {r["doc_id"] for r in kept.collect()}


def test_language_without_anything_to_learn(spark):
    rows = [(1, "some text", None, None, None), (2, None, "en", None, None)]
    assert {r["lang_pred"] for r in langid.language_scores(documents(spark, rows)).collect()} == {"und"}
    assert langid.language_scores(spark.createDataFrame([], SCHEMA)).count() == 0
    one = langid.language_scores(documents(spark, [(1, "some text", "en", None, None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in one] == [("en", 1.0)]


def test_character_grams():
    from callmeter.llm.text import slices

    texts = ["ab", "é中x", "", "ABé"]
    (s,) = slices([pa.RecordBatch.from_pydict({"text": texts})])
    for n, (bucket, first) in enumerate(langid.char_grams(s), start=1):
        assert [first[i + 1] - first[i] for i in range(4)] == [max(0, len(t) - n + 1) for t in texts]
    unigrams, first = next(langid.char_grams(s))
    assert list(unigrams[first[0] : first[1]]) == list(unigrams[first[3] : first[3] + 2])


def test_ftrl_separates_and_stays_sparse():
    rng = np.random.default_rng(1)
    examples = []
    for _ in range(400):
        label = int(rng.integers(2))
        noise = rng.choice(np.arange(2, 500), 5, replace=False)
        examples.append((np.sort(np.append(noise, label)), np.ones(6), label))
    w = linear.ftrl(examples, 500, 1, l1=1.0)[:, 0]
    assert w[0] < 0 < w[1] and (w[2:500] == 0).mean() > 0.5
    two = linear.ftrl(examples, 500, 2)
    assert two[0, 0] > two[0, 1] and two[1, 1] > two[1, 0]


def test_empty_frames_have_stable_columns(spark):
    empty = documents(spark, [])
    assert sorted_rows(langid.keep_identified(empty)) == []

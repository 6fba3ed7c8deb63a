"""The dual-tree search against a plain ranking of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from callmeter.llm import lexical
from tests.llm.cases import awkward_rows, clashing, documents, sentence

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def expected(docs, items, top=10):
    held = [(i, terms(t)) for i, t in docs]
    df = Counter(t for _, own in held for t in set(own))
    n = sum(bool(own) for _, own in held)
    total = sum(len(own) for _, own in held)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scored = []
        for doc_id, own in held:
            times = Counter(own)
            m = 100 - 75 + 75 * len(own) * n // total if total else 0
            score = sum(weight[t] * (10**9 * times[t] // (1000 * times[t] + 8 * m)) for t in terms(text) if t in times)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:top], start=1):
            out.append((item, rank, None if none else doc_id, -score))
    return sorted(out, key=repr)


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, docs, items, **settings):
    return sorted(map(tuple, lexical.ranked_documents(docs, items_table(spark, items), **settings).collect()), key=repr)


def corpus(seed, size, vocabulary):
    rng = random.Random(seed)
    # Words of very different frequency.
    words = [f"w{k}" for k in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 60)))) for i in range(size)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 30)))) for i in range(30)]
    docs += [(size + i, f"before, {text.upper()}! {text}") for i, (_, text) in enumerate(items[:9])]
    return docs, items


@pytest.mark.parametrize("block_terms", [40, 1 << 16])
def test_against_all_scores(spark, monkeypatch, block_terms):
    monkeypatch.setattr(lexical, "LEAF", 4)
    monkeypatch.setattr(lexical, "FIRST", 50)
    docs, items = corpus(1, 700, 300)
    table = documents(spark, [(i, t, None, None, 0) for i, t in docs]).repartition(3)
    assert found(spark, table, items, block_terms=block_terms) == expected(docs, items)


def test_awkward_rows(spark):
    rows = awkward_rows()
    docs = [(r[0], r[1]) for r in rows]
    items = [
        (1, "plain WORDS, of a text"), (1, "plain words of a text"), (2, None), (3, ""), (4, "!! ..."), (5, "never heard"),
        (None, "a text without an id"), (6, "a a a text Ünïcödé 中文 😀 don"), (7, "x" * 3000), (8, sentence(random.Random(5), 6000)),
    ]
    assert found(spark, documents(spark, rows), items) == expected(docs, items)
    assert found(spark, clashing(documents(spark, rows)), items) == expected(docs, items)
    twice = clashing(items_table(spark, items)).withColumnRenamed("score", "doc_id")
    assert lexical.benchmark_search(documents(spark, rows), twice).count() == len(expected(docs, items))
    assert found(spark, documents(spark, []), items) == []
    assert found(spark, documents(spark, rows), []) == []
    assert found(spark, documents(spark, rows), [(1, None)]) == []
    # Ties beyond the tenth place, and copies of one row.
    many = [(i % 40, "same words here") for i in range(50)] + [(99, "other")]
    table = documents(spark, [(i, t, None, None, 0) for i, t in many])
    assert found(spark, table, [(1, "words")]) == expected(many, [(1, "words")])


def test_scores_beyond_exact_floats():
    """Whole numbers are used where sums may exceed what floating point holds exactly."""
    weights = np.array([30_000, 20_001], dtype=np.int64)
    tree = lexical.ItemTree([np.zeros(400_000, np.int64), np.array([0, 1])], weights)
    assert tree.most > 2.0**53
    search = lexical.Search(tree, weights, np.zeros(2), 10)
    impact = np.array([999_999, 999_998, 7], dtype=np.int64)
    search.add([5, 6], np.array([1, 2]), np.array([0, 0, 1]), np.array([1, 2]), impact)
    best = {(item, doc): score for item, doc, score in search.found()}
    assert best[0, 5] == 400_000 * 30_000 * 999_999 and best[1, 6] == 30_000 * 999_998 + 20_001 * 7


def test_bounds_leave_out_most_pairs():
    """Documents without an item's rare words are not scored once its places are taken."""
    rng = random.Random(2)
    weights = np.array([100] * 10 + [9000] * 90, dtype=np.int64)
    items = [np.array([*range(10), 10 + i, 20 + i, 30 + i]) for i in range(10)]
    search = lexical.Search(lexical.ItemTree(items, weights), weights, np.zeros(10), 10)
    for batch in range(20):
        own = [sorted({*rng.sample(range(10), 5), *([10 + batch % 10, 20 + batch % 10, 30 + batch % 10] if d < 20 else [])}) for d in range(640)]
        size = np.array([len(o) for o in own])
        term = np.array([t for o in own for t in o])
        search.add(list(range(batch * 640, batch * 640 + 640)), size, term, size, np.full(len(term), 1000))
    assert search.scored < 0.4 * 20 * 640 * 10


def test_blocks_are_bounded(spark):
    from pyspark.sql import functions as F

    from callmeter.llm.blocks import running_blocks
    from callmeter.operators.durable import cut_lineage

    rows = spark.range(500, numPartitions=7).withColumn("row", F.monotonically_increasing_id())
    rows = cut_lineage(rows.withColumn("size", F.when(F.col("id") == 300, 5000).otherwise(F.col("id") % 9)))
    blocks = running_blocks(rows, "size", 100).groupBy("block").agg(F.sum("size").alias("n"), F.max("size").alias("most")).collect()
    assert sum(r["n"] for r in blocks) == rows.agg(F.sum("size")).first()[0]
    assert all(r["n"] < 100 + r["most"] for r in blocks)

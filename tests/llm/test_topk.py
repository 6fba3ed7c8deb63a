"""Exact search against all products."""

from __future__ import annotations

import math
import random

import pytest

from callmeter.llm import topk


def expected(rows, top=10):
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (query, q) in enumerate(usable):
        if query is None or query % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), i is None, i or 0) for b, (i, v) in enumerate(usable) if b != a]  # noqa: B905
        for rank, (score, none, i) in enumerate(sorted(scores)[:top], start=1):
            out.append((query, rank, None if none else i, -score))
    return sorted(out, key=repr)


def found(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, topk.embedding_neighbours(table).collect()), key=repr)


def vectors(n, dim, seed, spread):
    """Floats that 32 bits hold exactly."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = math.exp(rng.gauss(0, spread))
        out.append((i, [round(rng.gauss(0, size) * 256) / 256 for _ in range(dim)]))
    return out


@pytest.mark.parametrize(("dim", "spread"), [(24, 0.0), (24, 1.0), (3, 0.5)])
def test_against_all_products(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rows = vectors(900, dim, 1, spread)
    assert found(spark, rows) == expected(rows)


def test_ties_copies_and_odd_vectors(spark):
    rows = vectors(150, 4, 2, 0.2)
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(300)]
    rows += [(100, rows[100][1]), (200, None), (300, [1.0, None]), (400, [float("nan"), 0.0]), (500, [float("inf")])]
    rows += [(600, []), (700, [1.0]), (800, [1.0, 0.5, 0.25, 0.125, 2.0]), (None, [0.5, 0.5, 0.5, 0.5]), (900, [3.0e4] * 4)]
    assert found(spark, rows) == expected(rows)


def test_few_and_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0])]) == []
    assert found(spark, [(100, [1.0]), (1, [2.0])]) == [(100, 1, 1, 1024 * 2048)]


def test_large_components_are_exact(spark):
    rows = [(100 * i, [2.0**20 + i, -(2.0**19) + 3 * i, 7.0]) for i in range(20)]
    assert found(spark, rows) == expected(rows)


def test_short_vectors_are_pruned():
    import numpy as np
    import pyarrow as pa

    def block(vectors, first):
        matrix = np.array(vectors, dtype=np.int64)
        ids = np.arange(first, first + len(matrix))
        batch = pa.RecordBatch.from_pydict(
            {
                "size": [len(matrix)], "dim": [matrix.shape[1]], "longest": [0.0],
                "ids": [ids.tobytes()], "rows": [ids.tobytes()], "vectors": [matrix.tobytes()],
            }
        )
        made = topk._Block(batch, 0, matrix.shape[1])
        made.rotate(np.eye(matrix.shape[1]))
        return made

    queries, long, short = block([[5, 5]], 0), block([[900, 900]] * 12, 10), block([[1, 1]] * 50, 100)
    best = topk._Best(queries, 10)
    assert topk.search_block(best, queries, long) == 12
    assert topk.search_block(best, queries, short) == 0


def test_blocks_sent_are_blocks_computed(spark, monkeypatch):
    """Lengths decide which blocks meet before any vector is sent, and nearly all that meet compute something."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "STRIPE", 2)
    monkeypatch.setattr(topk, "GROUP", 2)
    sent, computed = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    plain = topk.search_block

    def counted(best, queries, candidates):
        pairs = plain(best, queries, candidates)
        if best.least.max() > -math.inf:
            sent.add(1)
            computed.add(pairs > 0)
        return pairs

    monkeypatch.setattr(topk, "search_block", counted)
    rows = vectors(900, 24, 3, 1.5)
    assert found(spark, rows) == expected(rows)
    blocks, queries = math.ceil(900 / 16), math.ceil(9 / 2)
    assert 0 < sent.value < 0.3 * blocks * queries
    assert computed.value > 0.5 * sent.value


def test_meetings_follow_lengths():
    blocks = [{"block": k, "longest": 10.0 - k} for k in range(7)]
    queries = [{"block": 10, "reach": -math.inf}, {"block": 11, "reach": 8.0}, {"block": 12, "reach": 20.0}]
    topk_stripe, topk_group = topk.STRIPE, topk.GROUP
    try:
        topk.STRIPE, topk.GROUP = 2, 1
        held, asked = topk._meetings(blocks, queries)
    finally:
        topk.STRIPE, topk.GROUP = topk_stripe, topk_group
    assert asked == [(10, 0, 4), (11, 1, 2)]
    assert held == [(0, 0, 2), (1, 0, 2), (2, 1, 2), (3, 1, 2), (4, 2, 1), (5, 2, 1), (6, 3, 1)]

"""The n-gram join against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter
from contextlib import redirect_stdout
from io import StringIO
from itertools import combinations

import numpy as np
import pytest

from callmeter.llm import ngram_join, registry
from tests.llm.cases import SCHEMA, clashing, documents, sentence


def gram_set(text):
    words = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")
    words = [w.lower() for w in words]
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def all_pairs(rows):
    """Links and least id of the class, per row, over all pairs of rows."""
    sets = [gram_set(r[1]) for r in rows]
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(r[0], ids.get(find(i), r[0]))
    return sorted(((r[0], ids.get(find(i)), links[i]) for i, r in enumerate(rows)), key=repr)


def found(spark, rows, **settings):
    out = ngram_join.similar_documents(documents(spark, rows), recall=0.9999, **settings)
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in out.collect()), key=repr)


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
    return " ".join(words)


def near_copies():
    rng = random.Random(3)
    rows = [(i, sentence(rng, 60), None, None, None) for i in range(60)]
    for i in range(60, 160):
        rows.append((i, edited(rng, rows[rng.randrange(20)][1], rng.randrange(4)), None, None, None))
    # A large group of edits of edits, exact copies among them.
    base = sentence(rng, 80)
    for i in range(160, 260):
        rows.append((i, edited(rng, rng.choice([base, rows[-1][1]]), rng.randrange(3)), None, None, None))
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_all_links_and_classes(spark, block):
    rows = near_copies()
    assert found(spark, rows, block=block) == all_pairs(rows)


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    out = ngram_join.similar_documents(docs)
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in out.collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got == all_pairs(rows)
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 3, 4, None, None, 5, 6, 7, 8, 9], key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.similar_documents(empty).collect() == []
    assert ngram_join.keep_one_of_each(empty).collect() == []


def test_least_document_of_each_class_stays(spark):
    rows = near_copies()
    kept = {r["doc_id"] for r in ngram_join.keep_one_of_each(documents(spark, rows), recall=0.9999).collect()}
    assert kept == {least for _, least, _ in all_pairs(rows)}


def test_query_on_given_tables(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = registry.QUERIES["op8_ngram_jaccard"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == all_pairs(rows)


def test_chosen_bandings_reach_their_recall():
    for similarity in (0.5, 0.8, 0.95):
        for recall in (0.9, 0.998):
            banding = ngram_join.choose_banding(similarity, recall)
            assert banding.recall(similarity) >= recall
            assert banding.rows * banding.bands <= 64 or banding.rows == 1


def test_components_of_chains_stars_and_pairs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 3), (3, 7), (9, 9)]
    rng.shuffle(edges)
    out = ngram_join.components(spark.createDataFrame(edges, "a long, b long"))
    expected = {i: 100 for i in range(101, 161)} | {500 + i: 500 for i in range(1, 40)} | {7: 3}
    assert {r["node"]: r["root"] for r in out.collect()} == expected


def test_forest_spans_the_components():
    linked = np.zeros((7, 7), bool)
    for a, b in [(6, 5), (5, 4), (4, 1), (2, 3)]:
        linked[a, b] = linked[b, a] = True
    assert ngram_join.forest(linked).tolist() == [0, 1, 2, 2, 1, 1, 1]


def test_a_class_has_the_least_id_of_its_rows(spark):
    """Copies with and without an id, and near copies of rows without one."""
    rng = random.Random(12)
    text = sentence(rng, 60)
    rows = [(i, text, None, None, None) for i in (None, 7, 5, None)] + [(None, edited(rng, text, 1), None, None, None), (9, None, None, None, None)]
    assert found(spark, rows) == all_pairs(rows)
    assert {r[1] for r in found(spark, rows)} == {5, 9}


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_kept_rows_are_dealt_once(spark, broadcast):
    """One row per id and text of least id, null last, with null ids and repeated rows; no shuffle after the join with what is kept."""
    text, other = "one two three four five six seven", "a b c d e f g h"
    rows = [(7, text, None, None, None), (7, text, None, None, None), (8, text, None, None, None), (None, text, None, None, None)]
    rows += [(None, other, None, None, None)] * 3 + [(None, None, None, None, None)] * 2 + [(0, None, None, None, None), (3, "", None, None, None)]
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, broadcast)
    try:
        kept = ngram_join.keep_one_of_each(documents(spark, rows))
        got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
        with redirect_stdout(StringIO()) as plan:
            kept.explain()
    finally:
        spark.conf.set(limit, before)
    assert got == sorted([(7, text), (None, other), (None, None), (0, None), (3, "")], key=repr)
    above, found_, _ = plan.getvalue().partition("LeftSemi")
    assert found_ and "Exchange" not in above.split("Initial Plan")[0]

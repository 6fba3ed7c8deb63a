"""Contaminated documents against a plain alignment of every item with every document."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from callmeter.llm import decontaminate, registry
from tests.llm.cases import SCHEMA, clashing, documents, sentence


def local_score(item, text):
    best, above = 0, [0] * (len(text) + 1)
    for word in item:
        here = [0] * (len(text) + 1)
        for j, other in enumerate(text, start=1):
            here[j] = max(0, above[j - 1] + (1 if word == other else -1), above[j] - 1, here[j - 1] - 1)
            best = max(best, here[j])
        above = here
    return best


def words(text):
    return [w.lower() for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]


def test_alignment_against_plain_code():
    rng = random.Random(2)
    for _ in range(60):
        item, text = ([rng.randrange(2, 6) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        score, start, end = decontaminate.align(np.array([item], np.uint64), np.array([text], np.uint64))
        assert score[0] == local_score(item, text)
        # The stretch alone gives the same score.
        assert local_score(item, text[start[0] : end[0]]) == score[0]


def planted():
    rng = random.Random(4)
    items = [(i, sentence(rng, 30, 2000)) for i in range(12)]
    rows, truth = [], set()
    for d in range(80):
        text = sentence(rng, 60, 2000).split(" ")
        if d % 4 == 0:
            item = d // 4 % 12
            copy = items[item][1].split(" ")
            for _ in range(d // 20):
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice([[], [f"edit{k}"], [copy[k], f"more{k}"]])
            text[20:20] = copy
            truth.add((d, item))
        rows.append((d, " ".join(text), None, None, None))
    return items, rows, truth


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_planted_passages(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    items, rows, truth = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents(spark, rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == truth
    texts, questions = dict((r[0], words(r[1])) for r in rows), {i: words(t) for i, t in items}
    for r in found:
        expected = local_score(questions[r["item_id"]], texts[r["doc_id"]])
        assert r["score"] * len(questions[r["item_id"]]) == pytest.approx(expected)
    kept = decontaminate.drop_contaminated(documents(spark, rows), bench)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in truth}


@pytest.mark.parametrize("verbatim", [False, True])
def test_edited_copies_beside_verbatim_ones(spark, verbatim):
    """All matches of a plain alignment: words replaced or inserted evenly, parts, a copy with a long insertion."""
    rng = random.Random(8)
    items, rows = [], []
    for i, size in enumerate([5, 8, 20, 40, 40, 41, 90] * 2):
        own = [f"q{i}x{k}" for k in range(size)] if i < 7 else sentence(rng, size, 30).split(" ")
        items.append((i, " ".join(own)))
        copies = [own[: (size + 1) // 2], own[size // 2 :], own[: size // 2] + [f"y{k}" for k in range(size // 3)] + own[size // 2 :]]
        for every in (2, 3, 4, 5, 6):
            copies.append([f"z{k}" if k % every == every - 1 else w for k, w in enumerate(own)])
            copies.append([x for k, w in enumerate(own) for x in ([w, f"z{k}"] if k % every == every - 1 else [w])])
        for copy in copies + [own] * verbatim:
            before, after = (sentence(rng, 30).split(" ") for _ in range(2))
            rows.append((len(rows), " ".join(before + copy + after), None, None, None))
    truth = {}
    for d, text, *_ in rows:
        for i, item in items:
            score = local_score(words(item), words(text)) / len(words(item))
            if score >= 0.5:
                truth[d, i] = score
    found = decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == pytest.approx(truth)
    assert len(truth) > 100


def test_long_items_and_repeats(spark):
    rng = random.Random(6)
    long = sentence(rng, 700, 5000)
    items = [(1, long), (2, None), (3, "too short"), (None, sentence(rng, 20)), (1, "a wholly different test item of eight words")]
    rows = [
        (1, "before " + long + " after", None, None, None),
        (2, long[len(long) // 3 :], None, None, None),
        (3, "a wholly different test item of eight words twice: a wholly different test item of eight words", None, None, None),
        (3, "too short", None, None, None),
        (4, None, None, None, None),
    ]
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"))
    found = decontaminate.contamination(clashing(documents(spark, rows)), bench).collect()
    # A part of an item has its share of the whole.
    scores = {(r["doc_id"], r["item_id"]): r["score"] for r in found}
    assert len(found) == 3 and scores == pytest.approx({(1, 1): 1.0, (2, 1): 467 / 700, (3, 1): 1.0})


def test_short_items_and_parts_of_long_ones(spark):
    """Three and four words are enough; a part of a long item scores its share of the whole item."""
    rng = random.Random(9)
    long = sentence(rng, 385, 5000).split(" ")
    items = [(1, "four words copied whole"), (2, "three rare words"), (3, " ".join(long)), (4, " ".join(long[:383])), (5, "one")]
    rows = [
        (1, "it has four words copied whole in it", None, None, None),
        (2, "here are three rare words", None, None, None),
        (3, "before " + " ".join(long[:256]) + " after", None, None, None),
        (4, "one clean text with words", None, None, None),
    ]
    found = decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == pytest.approx(
        {(1, 1): 1.0, (2, 2): 1.0, (3, 3): 256 / 385, (3, 4): 256 / 383}
    )
    with pytest.raises(ValueError):
        decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), min_words=2)


def test_repeated_items_stay_within_a_block(spark, monkeypatch):
    rng = random.Random(10)
    texts = [sentence(rng, 100, 3000) for _ in range(6)]
    items = [(i, texts[i % 6]) for i in range(200)]
    rows = [(d, f"some {texts[d]} more", None, None, None) for d in range(6)] + [(0, "some " + texts[0], None, None, None)]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 150)
    sizes, collect = [], decontaminate._blocks
    monkeypatch.setattr(decontaminate, "_blocks", lambda *a: (sizes.append(sum(len(r["words"]) for r in b) // 8) or b for b in collect(*a)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents(spark, rows), bench).collect()
    assert len(sizes) > 1 and max(sizes) < 150 + 100
    expected = [(d, i) for d in [*range(6), 0] for i in range(200) if i % 6 == d]
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(expected) and {r["score"] for r in found} == {1.0}


def test_hits_too_far_apart():
    pairs = decontaminate._pairs(np.arange(2, 12, dtype=np.uint64)).view(np.int64).tolist()
    held = decontaminate._Items([np.arange(2, 12, dtype=np.uint64).tobytes()], [pairs], [2], 0.5)
    text = np.array([2, 3, *[1] * 40, 10, 11], np.uint64)
    whole = decontaminate.Slice(None, None, None, hashes=text, first=np.array([0, len(text)]))
    assert len(held.candidates(whole)) == 0


def test_awkward_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, sentence(random.Random(1), 12))], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    docs = clashing(documents(spark))
    assert decontaminate.contamination(docs, bench).collect() == []
    assert decontaminate.contamination(docs, none).columns == ["doc_id", "item_id", "score", "start_word", "end_word"]
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count() == decontaminate.drop_contaminated(docs, bench).count()
    assert decontaminate.contamination(spark.createDataFrame([], SCHEMA), bench).collect() == []


def test_query_on_given_tables(spark, sf_dir):
    found = registry.QUERIES["op10_decontamination"](spark, sf_dir).collect()
    docs = {r["doc_id"]: " ".join(words(r["text"])) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(words(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    verbatim = {(d, i) for d, text in docs.items() for i, item in items.items() if f" {item} " in f" {text} "}
    assert verbatim <= {(r["doc_id"], r["item_id"]) for r in found} and verbatim

"""Toxicity on held-out rows, misspelled and quoted terms, and the automaton against edit distances."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from callmeter.llm import toxicity
from callmeter.llm.text import slices
from tests.llm.cases import SCHEMA, awkward_rows, clashing, documents

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        before, row = row, [i]
        for j, y in enumerate(b, start=1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


ENTRIES = [("idiot", False), ("moron", False), ("worthless", False), ("scum", False), ("ass", False), ("lowei", True), ("abscheul", True)]


def closest(word, entries):
    best = None
    for number, (text, stem) in enumerate(entries):
        parts = [word[:k] for k in range(len(word) + 1)] if stem else [word]
        found = min(distance(p, text) for p in parts)
        if found <= toxicity.edits(len(text), stem) and (best is None or (found, number) < best):
            best = (found, number)
    return best


def mutated(rng, word):
    word = list(word)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(word) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            word.insert(at, rng.choice("abotm*1é😀"))
        elif word and kind == 1:
            del word[min(at, len(word) - 1)]
        elif word:
            word[min(at, len(word) - 1)] = rng.choice("abotm01éi")
    return "".join(word)


def test_automaton_against_edit_distances():
    rng = random.Random(1)
    trie = toxicity.Trie(ENTRIES)
    for _ in range(4000):
        word = mutated(rng, rng.choice(ENTRIES)[0] + rng.choice(["", "", "chen", "t"]))
        assert trie.match(word) == closest(word, ENTRIES)


def hits_of(texts, entries=ENTRIES):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    matcher = toxicity.Matcher(entries)
    return [h for s in slices([batch]) for h in matcher.hits(s)[0]]


def test_no_close_word_is_passed_over():
    rng = random.Random(2)
    words = [mutated(rng, rng.choice(ENTRIES)[0] + rng.choice(["", "", "chen"])) for _ in range(3000)]
    words = [w for w in words if w and all(c.isalnum() and c.islower() or c.isdigit() for c in w)]
    found = hits_of(words)
    for word, hits in zip(words, found, strict=True):
        best = closest(word, ENTRIES)
        assert [(h[1], h[0]) for h in hits] == ([best] if best else [])


def test_contexts():
    texts = [
        "you Idiot you", 'they wrote "what an idiot" on it', "someone said idiot to them", "> idiot as above", "«idiot» dit-on", "l'idiot et l'autre",
        "id*ot and MOR0N!!", "idiot,moron", "he's a moron, isn't he", "it is 'moron' there", "„idiot“ stand da", 'a "quote" before idiot and "one" after',
    ]
    found = [[h[2] for h in hits] for hits in hits_of(texts)]
    plain, reported, quoted = toxicity.PLAIN, toxicity.REPORTED, toxicity.QUOTED
    assert found == [
        [plain], [quoted], [reported], [quoted], [quoted], [plain], [plain, plain], [plain, plain], [plain], [quoted], [quoted], [reported]
    ]


def test_entries():
    toxic = {("low", True): 90, ("lowe", True): 90, ("lowei", True): 90, ("loweia", True): 40, ("the", True): 100, ("the", False): 99}
    toxic |= {("idi", True): 50, ("idio", True): 50, ("idiot", True): 50, ("idiot", False): 50, ("rare", False): 2}
    clean = {("the", True): 1000, ("the", False): 990, ("low", True): 8}
    assert toxicity.choose_entries(toxic, clean, 100, 1000) == {("idiot", False): 1.0, ("lowei", True): 1.0}


def corpus(spark):
    """Toxic and clean texts, of which some hold terms misspelled, quoted or reported."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(1200):
        own = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        toxic = i % 5 == 0
        kind = rng.randrange(3)
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            term = rng.choice(["idiot", "moron", "worthless", "scum"])
            own.insert(rng.randrange(len(own)), term if kind else term[:2] + "x" + term[3:])
        if not toxic and i % 7 == 0:
            own[1:1] = ["wrote", '"such', "an", rng.choice(["idiot", "moron"]) + '"']
        rows.append((i, " ".join(own), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {r[0]: r[2] for r in labels}


def test_misspelled_and_quoted_terms(spark):
    docs, labels, truth = corpus(spark)
    found = toxicity.toxicity_scores(docs, labels).collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 200 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    caught = [r["predicted"] for r in held if truth[r["doc_id"]]]
    spared = [1 - r["predicted"] for r in held if not truth[r["doc_id"]]]
    assert sum(caught) > 0.95 * len(caught) and sum(spared) > 0.97 * len(spared)


def test_held_out_labels_of_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert len(scores) == docs.count()
    rows = labels.join(docs.select("doc_id", "lang"), "doc_id").join(spark.createDataFrame([("en",)], "lang string"), "lang", "left").collect()
    held = [(scores[r["doc_id"]]["predicted"], r["toxic"]) for r in rows if scores[r["doc_id"]]["held_out"]]
    caught = [p for p, t in held if t]
    spared = [1 - p for p, t in held if not t]
    # Texts made of junk keep the label of the text they replaced.
    assert sum(caught) > 0.9 * len(caught) and sum(spared) > 0.98 * len(spared)


def test_learns_nothing_from_held_out_labels(spark):
    docs, labels, _ = corpus(spark)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit_toxicity(docs, x, toxicity.learnable()) for x in (labels, flipped))
    assert a.entries == b.entries and a.worth == b.worth and (a.weights == b.weights).all()


def test_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, 1, 0), (8, None, None), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity_scores(clashing(docs), clashing(labels))
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}) == 1


@pytest.mark.parametrize("filled", [False, True])
def test_empty_tables(spark, filled):
    docs, labels = documents(spark, None if filled else []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert {r["score"] for r in rows} <= {0.5} and len(rows) == docs.count()
    assert spark.createDataFrame([], SCHEMA).count() == 0

"""The language model against plain sums, and as a probability distribution."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from callmeter.llm import lm, registry
from callmeter.llm.text import Hasher, slices
from tests.llm.cases import SCHEMA, awkward_rows, clashing, documents, sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def check_base(rows, found):
    """Counts and base scores by plain sums."""
    counts = Counter(t for doc_id, text in rows if not held_out(doc_id) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        expected.append((doc_id, held_out(doc_id), len(own), sum(counts[t] > 0 for t in own), total, base))
    got = sorted((tuple(r)[:6] for r in found), key=repr)
    for g, e in zip(got, sorted(expected, key=repr), strict=True):
        assert g[:5] == e[:5] and g[5] == pytest.approx(e[5], rel=1e-9)


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 700])
def test_query_on_given_tables(spark, sf_dir, monkeypatch, frequent):
    """With few broadcast words most counts come from the join."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = registry.QUERIES["op7_language_model"](spark, sf_dir).collect()
    check_base(rows, found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in found)


def test_join_and_broadcast_give_equal_scores(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    model, counts = lm.fit(docs, rounds=1)
    scored = {r["doc_id"]: r["score"] for r in lm.score(docs, model, counts).collect()}
    few = np.lexsort((model.frequent, -model.frequent_n))[:600]
    few = few[np.argsort(model.frequent[few])]
    model.frequent, model.frequent_n = model.frequent[few], model.frequent_n[few]
    again = {r["doc_id"]: r["score"] for r in lm.score(docs, model, counts).collect()}
    assert scored == pytest.approx(again, rel=1e-6)


def test_probabilities_sum_to_one(spark):
    """Over all known words, the end and the unknown type, after several histories."""
    docs = documents(spark, [(i, f"the cat {w} on the mat w{i} and {w}!", None, None, None) for i, w in enumerate(["sat", "lay", "ran"] * 300)])
    model, counts = lm.fit(docs)
    words = sorted({t for r in docs.collect() for t in tokens(r["text"])[:-1]})
    assert len(words) > lm.HEAD
    for history in ("", "the", "the cat", "w7 and"):
        last = [*words, "never-seen", None]
        texts = [f"{history} {w}".strip() if w is not None else history for w in last]
        longer = documents(spark, [(i, t, None, None, None) for i, t in enumerate([*texts, history])])
        scores = {r["doc_id"]: r["score"] for r in lm.score(longer, model, counts).collect()}
        # The score of a text ends with its end; take that of the end away again.
        (s,) = slices([pa.RecordBatch.from_pydict({"text": texts})])
        t = lm.tokens(s, Hasher())
        number = model.head_number(t.keys)
        p = lm._probabilities(model.class_logits(model.contexts(t, number), slice(None)))
        ends = np.log10(p[t.first[1:] - 1, lm.END_CLASS])
        before = scores[len(texts)] - ends[len(last) - 1]
        chance = [10 ** (scores[i] - ends[i] - before) for i in range(len(last) - 1)] + [10 ** ends[len(last) - 1]]
        assert sum(chance) == pytest.approx(1, abs=2e-3)


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    found = lm.lm_scores(docs)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check_base([r[:2] for r in awkward_rows()], found.collect())
    assert all(math.isfinite(r["score"]) for r in found.collect())


def test_nothing_to_learn_from(spark):
    assert lm.lm_scores(spark.createDataFrame([], SCHEMA)).collect() == []
    out = next(i for i in range(100) if held_out(i))
    (row,) = lm.lm_scores(documents(spark, [(out, "some words", None, None, None)])).collect()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)
    assert row["score"] == pytest.approx(0, abs=1e-6)


def test_the_layout_of_files_changes_little(spark):
    """One table in 1 and in 64 partitions."""
    rng = random.Random(21)
    rows = [(i, sentence(rng, rng.randrange(40, 120), 300), None, None, None) for i in range(1500)]
    docs = documents(spark, rows)
    per_token = []
    for n in (1, 64):
        found = lm.lm_scores(docs.repartition(n)).filter("held_out").collect()
        per_token.append(sum(r["score"] for r in found) / sum(r["n_tokens"] for r in found))
    assert abs(per_token[0] - per_token[1]) < 0.01


def test_pairs_of_the_tail_are_learned(spark):
    """Documents of fixed pairs of words: who knows the pairs needs about -1.8 a token, counts alone -3.9."""
    rng = random.Random(5)
    pairs = [(f"a{i}", f"b{rng.randrange(10**6)}x{i}") for i in range(4000)]
    rows = [(i, " ".join(" ".join(pairs[rng.randrange(4000)]) for _ in range(50)), None, None, None) for i in range(3000)]
    found = lm.lm_scores(documents(spark, rows)).filter("held_out").collect()
    assert sum(r["score"] for r in found) / sum(r["n_tokens"] for r in found) > -2.3


def plain_scores(model, learned, texts):
    """The score of each text token by token, from plain counts and the trained weights."""

    def one(text):
        (s,) = slices([pa.RecordBatch.from_pydict({"text": [text]})])
        t = lm.tokens(s, Hasher())
        return t, [int(k) for k in t.keys], [0, *(int(k) >> 40 & 65535 for k in t.keys[:-1])]

    end = int(lm.END_KEY)
    number = dict(zip((int(k) for k in model.head), (int(x) for x in model.head_slot), strict=True))

    def label(key):
        if key == end:
            return lm.END_CLASS
        return number[key] // lm.CLASS_WORDS if key in number else lm.HEAD_CLASSES + key % 32

    words, after, of_class = Counter(), Counter(), Counter()
    for text in learned:
        _, keys, before = one(text)
        words.update(keys)
        after.update(zip(before, keys, strict=True))
        of_class.update((b, label(k)) for b, k in zip(before, keys, strict=True))
    in_tail = {pair: n for pair, n in after.items() if lm.HEAD_CLASSES <= label(pair[1]) < lm.END_CLASS}
    once, twice = (sum(n == k for n in in_tail.values()) for k in (1, 2))
    d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    left = {pair: 1.0 for pair in of_class}
    for (b, k), n in in_tail.items():
        if n >= 2:
            left[b, label(k)] -= (n - d) / of_class[b, label(k)]
    tail_words = {c: [k for k in words if label(k) == c] for c in range(lm.HEAD_CLASSES, lm.END_CLASS)}
    mass, unseen = {}, {}
    for c, own in tail_words.items():
        mass[c] = max(sum(words[k] + 0.1 for k in own), 0.1)
        unseen[c] = (sum(words[k] == 1 for k in own) + 0.5) / (sum(words[k] for k in own) + 1) if own else 1.0
    share = np.exp(model.prior.astype(float))
    share /= share.sum()
    in_context = Counter()
    for (b, _), n in of_class.items():
        in_context[b] += n
    for text in texts:
        t, keys, before = one(text)
        two, pair, one_, _ = model.contexts(t, model.head_number(t.keys))
        total = 0.0
        for i, (k, b) in enumerate(zip(keys, before, strict=True)):
            others = in_context[b] - sum(of_class[b, c] for c in range(lm.HEAD_CLASSES, lm.END_CLASS))
            rest = 1 - share[lm.HEAD_CLASSES : lm.END_CLASS].sum()
            n = [of_class[b, c] if lm.HEAD_CLASSES <= c < lm.END_CLASS else others * share[c] / rest for c in range(lm.CLASSES)]
            start = [(n[c] + 4 * share[c]) / (in_context[b] + 4) for c in range(lm.CLASSES)]
            z = [
                math.log(x) + float(model.weights[two[i], c] + model.weights[pair[i], c]) if x else -1e4
                for c, x in enumerate(start)
            ]
            norm = sum(math.exp(x) for x in z)
            p = [math.exp(x) / norm for x in z]
            c = label(k)
            if k not in words:
                chance = sum(p[c] * u for c, u in unseen.items())
            elif c == lm.END_CLASS:
                chance = p[c]
            elif k in number:
                row = one_[i] % lm.HEAD_CONTEXTS * lm.HEAD_CLASSES + c
                inner = np.exp(model.head_log[c].astype(float) + model.head_weights[row])
                chance = p[c] * inner[number[k] % lm.CLASS_WORDS] / inner.sum()
            else:
                inner = left.get((b, c), 1.0) * (words[k] + 0.1) / mass[c]
                if after[b, k] >= 2:
                    inner += (after[b, k] - d) / of_class[b, c]
                chance = p[c] * (1 - unseen[c]) * inner
            total += math.log10(chance)
        yield total


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 600])
def test_score_by_plain_sums(spark, monkeypatch, frequent):
    """Counts and weights at hand or joined, known and unknown words, repeated and long texts."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rng = random.Random(8)
    texts = [sentence(rng, rng.randrange(0, 60), 1500) for _ in range(400)]
    texts += [texts[0]] * 5 + [" ".join(texts[:40])]
    model, table = lm.fit(documents(spark, [(i, x, None, None, None) for i, x in enumerate(texts)]))
    asked = [*texts[:60], texts[-1], "", "never seen words", texts[1] + " unknown " + texts[2]]
    found = lm.score(documents(spark, [(i, x, None, None, None) for i, x in enumerate(asked)]), model, table)
    got = {r["doc_id"]: r["score"] for r in found.collect()}
    for i, expected in enumerate(plain_scores(model, texts, asked)):
        assert got[i] == pytest.approx(expected, rel=1e-4, abs=1e-3)


def test_weights_grow_with_the_corpus(spark):
    """Twice the vocabulary gives about twice the stored weights."""
    sizes = []
    for vocabulary in (2000, 4000):
        rows = [(i, " ".join(f"w{(i * 7 + j) % vocabulary}" for j in range(60)), None, None, None) for i in range(vocabulary)]
        _, table = lm.fit(documents(spark, rows))
        sizes.append(sum(len(r["keys"]) // 8 for r in table.filter(f"kind = {lm._PAIR}").collect()))
    assert sizes[1] > 1.8 * sizes[0] > 0

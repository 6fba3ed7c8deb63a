"""The quality and language learners against plain code that takes one number at a time."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callmeter.llm import langid, linear, quality
from callmeter.llm.text import Hasher, mix, seeds, slices
from tests.llm.cases import sentence

U64 = (1 << 64) - 1
ALPHA, BETA, EPOCHS = 0.5, 1.0, 2


def plain_ftrl(examples, size, classes, l1, l2):
    """Follow-the-regularised-leader, coordinate by coordinate; the intercept is the feature ``size``."""
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= l1:
            return 0.0
        return -math.copysign(abs(z[key]) - l1, z[key]) / ((BETA + math.sqrt(n[key])) / ALPHA + l2)

    for _ in range(EPOCHS):
        for x, label in examples:
            x = {**x, size: 1.0}
            w = {(i, c): weight((i, c)) for i in x for c in range(classes)}
            scores = [sum(v * w[i, c] for i, v in x.items()) for c in range(classes)]
            if classes == 1:
                errors = [1 / (1 + math.exp(-scores[0])) - label]
            else:
                total = sum(math.exp(s - max(scores)) for s in scores)
                errors = [math.exp(s - max(scores)) / total - (c == label) for c, s in enumerate(scores)]
            for i, v in x.items():
                for c, error in enumerate(errors):
                    g, before = v * error, n.get((i, c), 0.0)
                    step = (math.sqrt(before + g * g) - math.sqrt(before)) / ALPHA
                    z[i, c] = z.get((i, c), 0.0) + g - step * w[i, c]
                    n[i, c] = before + g * g
    return {key: weight(key) for key in z}


def averaged(shards, size, classes, l1, l2):
    """The mean of the shards' weights, by (feature, class)."""
    out = {}
    for examples in shards:
        for key, w in plain_ftrl(examples, size, classes, l1, l2).items():
            out[key] = out.get(key, 0.0) + w / len(shards)
    return out


def word_hash(token):
    hasher, data = Hasher(), np.frombuffer(token, np.uint8)
    return int(hasher.span(hasher.prefix(data), np.array([0]), np.array([len(token)]))[0])


def plain_mix(x):
    return int(mix(np.array([x & U64], dtype=np.uint64))[0])


def plain_lower(text):
    return "".join(c.lower() if c.isascii() or ("À" <= c <= "Þ" and c != "×") else c for c in text)


def look(token, glued):
    """The shape of a token."""
    if re.match(rb"[^0-9A-Za-z\x80-\xff]", token):
        shape = 3 + min(len(token), 3)
    elif re.match(rb"[0-9]", token):
        shape = 3
    elif re.match(rb"[A-Z]", token) or re.match("[À-Þ]", token[:2].decode("utf-8", "ignore")):
        shape = 2 if len(token) > 1 and re.search(rb"[A-Z]$", token) else 1
    else:
        shape = 0
    return shape + (0 if glued else 8)


def plain_features(text):
    """The ids of a text's features, with repeats."""
    data = text.encode()
    found = list(re.finditer(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", data))
    a, b, c = (int(x) for x in seeds(3, salt=5))
    out, previous, shape_before, end = [], 0, 32, None
    for m in found:
        word = word_hash(plain_lower(m.group().decode()).encode())
        shape = look(m.group(), end == m.start()) + (16 if word == previous else 0)
        out += [word, plain_mix(word * a + previous * b), plain_mix((shape + 1) * c), plain_mix((shape * 64 + shape_before + 100) * c)]
        previous, shape_before, end = word, shape, m.end()
    return [x >> (64 - quality.BITS) for x in out]


def plain_shares(text):
    ids = plain_features(text)
    return {i: ids.count(i) * 16.0 * 4 / len(ids) for i in ids}


def plain_grams(text):
    """For each order the buckets of a text's character n-grams."""
    codes = []
    for char in plain_lower(text):
        code, *rest = char.encode()
        for byte in rest:
            code = (code * 257 + byte) % (1 << 32)
        codes.append(code)
    out = []
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            gram = sum(codes[i + k] * int(langid._M[k]) for k in range(n)) % (1 << 32)
            out.append(((gram ^ (gram >> 15)) * (0x2C1B3C6D + 2 * n)) % (1 << 32) >> (32 - langid.BITS))
    return out


def texts(count=50):
    rng = random.Random(11)
    marks = ["Ein Wort, zwei WORTE!", "Ünïcödé 中文 😀 don't", "12 34 !!", "the the THE -- end...", "École à Âge"]
    return [f"{sentence(rng, rng.randrange(3, 20))} {rng.choice(marks)}" for _ in range(count - len(marks))] + marks


def as_slices(rows):
    return slices([pa.RecordBatch.from_pydict({"text": rows})])


def test_quality_features():
    """A row's features are those of its text, whatever row lies before it in the batch."""
    rows = texts()
    (s,) = as_slices(rows)
    ids, first = quality.features(s, Hasher())
    for i, text in enumerate(rows):
        assert sorted(ids[first[i] : first[i + 1]].tolist()) == sorted(plain_features(text))


def test_quality_weights_and_scores(spark):
    rows = [(i, t, int("!" in t or i % 3 == 0), i % 3) for i, t in enumerate(texts())]
    size, scale = 1 << quality.BITS, quality._SCALE * 4

    def examples(pdf):
        part = pdf.sort_values("id")
        for s in slices([pa.RecordBatch.from_pandas(part, preserve_index=False)]):
            ids, first = quality.features(s, Hasher())
            for i, label in enumerate(s.rows.column("label").to_pylist()):
                own, counts = np.unique(ids[first[i] : first[i + 1]], return_counts=True)
                yield own, counts * (scale / (first[i + 1] - first[i])), label

    sample = spark.createDataFrame(rows, "id long, text string, label int, shard int")
    w = linear.fit(sample, examples, size, 1, 3)
    plain = averaged([[(plain_shares(t), y) for _, t, y, k in rows if k == shard] for shard in range(3)], size, 1, 0.01, 0.01)
    assert set(np.flatnonzero(w[:, 0]).tolist()) <= {i for i, _ in plain}
    assert all(w[i, 0] == pytest.approx(x, rel=1e-4, abs=1e-6) for (i, _), x in plain.items())

    docs = sample.select(F.col("id").alias("doc_id"), "text")
    found = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, w).collect()}
    for i, t, *_ in rows:
        total = plain.get((size, 0), 0.0) + sum(v * plain.get((f, 0), 0.0) for f, v in plain_shares(t).items())
        assert found[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-4)


def test_production_examples_are_the_same_features():
    """What the registered query learns from holds each row once, with its label and its shares."""
    rows = texts()
    given = pd.DataFrame({"text": rows, "label": range(len(rows))})
    found = {label: dict(zip(ids.tolist(), values.tolist())) for ids, values, label in quality._examples(given)}
    assert found == {i: pytest.approx(plain_shares(t)) for i, t in enumerate(rows)}


def test_language_weights_and_scores(spark):
    rows = [(i, t, ("de", "en", "fr")[i % 3]) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df, total = langid._document_frequencies(docs)
    plain_df = {}
    for _, t, _ in rows:
        for b in set(plain_grams(t)):
            plain_df[b] = plain_df.get(b, 0) + 1
    assert total == len(rows) and {b: int(df[b]) for b in np.flatnonzero(df)} == plain_df

    model = langid.fit_language(docs)
    assert model.languages == ["de", "en", "fr"]
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.score_language(docs, model).collect()}
    for i, t, _ in rows:
        if not re.search(r"[^\W\d_]", t):
            assert found[i] == ("und", 0.0)
            continue
        grams = plain_grams(t)
        logits = [(sum(float(model.weights[g, c]) for g in grams) / len(grams) + float(model.weights[-1, c])) / model.temperature for c in range(3)]
        shares = [math.exp(x - max(logits)) for x in logits]
        best = max(range(3), key=lambda c: shares[c])
        assert found[i][0] == model.languages[best] and found[i][1] == pytest.approx(shares[best] / sum(shares), abs=1e-5)


def test_multinomial_weights():
    """The softmax learner on TF-IDF shares of character n-grams."""
    rows = [(t, i % 3) for i, t in enumerate(texts(20))]
    size = 1 << langid.BITS
    plain, quick = [], []
    for t, label in rows:
        grams = plain_grams(t)
        x = {g: grams.count(g) * 30.0 / len(grams) for g in set(grams)}
        plain.append((x, label))
        quick.append((np.array(sorted(x)), np.array([x[g] for g in sorted(x)]), label))
    w = linear.ftrl(quick, size, 3, l1=0.02, l2=0.02)
    expected = plain_ftrl(plain, size, 3, 0.02, 0.02)
    assert all(w[key] == pytest.approx(x, rel=1e-4, abs=1e-6) for key, x in expected.items())
    assert np.count_nonzero(w) == sum(x != 0 for x in expected.values())


def test_temperature_of_least_loss(spark):
    rows = [(i, t, ("de", "en")[i % 2]) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rng = np.random.default_rng(2)
    model = langid.LanguageModel(["de", "en"], rng.normal(size=((1 << langid.BITS) + 1, 2)).astype(np.float32))

    def loss(t):
        out = 0.0
        for _, text, lang in rows:
            grams = plain_grams(text)
            logits = [(sum(float(model.weights[g, c]) for g in grams) / len(grams) + float(model.weights[-1, c])) / t for c in range(2)]
            out += math.log(sum(math.exp(x) for x in logits)) - logits[lang == "en"]
        return out

    found = langid._fit_temperature(docs, model)
    assert found == min((float(t) for t in langid._TEMPERATURES), key=loss)

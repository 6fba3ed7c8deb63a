"""Runs against a search over all periods, and Lyndon lengths against their definition."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from callmeter.llm import periodic
from callmeter.llm.text import seeds
from tests.llm.cases import awkward_rows, clashing, documents, sorted_rows


def plain_runs(words, least=12):
    """All runs, from the stretches in which words one period apart are equal."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            # Of smallest period q: no smaller period holds for the whole stretch.
            smaller = any(all(words[k] == words[k + p] for k in range(start, end - p)) for p in range(1, q))
            if end - start >= max(least, 2 * q) and not smaller:
                out.add((start, end, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in runs)]
    best = (None,) * 4
    if runs:
        s, e, q = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]))
        best = (s, e - s, q, 1000 * (e - s) // q)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def lyndon_by_definition(word):
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    return [max(k for k in range(1, len(word) - i + 1) if is_lyndon(word[i : i + k])) for i in range(len(word))]


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_lyndon_lengths(letters):
    rng = random.Random(letters)
    for size in range(1, 40):
        word = [rng.randrange(letters) for _ in range(size)]
        dense = {c: i for i, c in enumerate(sorted(set(word)))}
        word = [dense[c] for c in word]
        assert periodic.lyndon_lengths(word) == lyndon_by_definition(word)
    assert periodic.lyndon_lengths([]) == []


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_runs_of_random_texts(letters):
    rng = random.Random(10 + letters)
    texts = [[rng.randrange(letters) for _ in range(rng.randrange(0, 90))] for _ in range(60)]
    for _ in range(40):
        base = [rng.randrange(letters + 3) for _ in range(rng.randrange(1, 20))]
        texts.append(([7] * rng.randrange(3) + base * rng.randrange(1, 9))[: rng.randrange(5, 90)] + [9] * rng.randrange(15))
    codes = seeds(20, salt=3)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = periodic.find_runs(codes[np.array([w for t in texts for w in t])], first)
    expected = [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t)]
    assert [tuple(r) for r in found.tolist()] == expected


def test_thue_morse_and_fibonacci():
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    codes = seeds(2)
    found = periodic.find_runs(codes[np.array(thue + b)], np.array([0, 4096, 4096 + len(b)]))
    assert [tuple(r[1:]) for r in found.tolist() if r[0] == 1] == plain_runs(b)
    # Thue and Morse's word holds squares, but no three copies and nothing beyond two.
    ours = found[found[:, 0] == 0]
    assert len(ours) and (ours[:, 2] - ours[:, 1] == 2 * ours[:, 3]).all()
    assert set((ours[:, 3]).tolist()) <= {2**k for k in range(12)} | {3 * 2**k for k in range(11)}


def test_rejects_short_runs():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(0, np.uint64), np.zeros(1, np.int64), least=8)


def test_query_on_awkward_rows(spark):
    rng = random.Random(4)
    rows = [r for r in awkward_rows() if r[0] != 5]
    tail = next(i for i in range(100, 1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    for i in (tail, tail + 1, 77):
        rows.append((i, " ".join(rng.choice("abc") for _ in range(150)), "en", "a", 1))
    rows += [(78, "a b " * 20 + "c\x0bd\x0c" * 9, "en", "a", 1), (tail, "one", None, None, 1), (tail, None, None, None, 1)]
    expected = sorted((plain_row(r[0], r[1]) for r in rows), key=repr)
    assert sorted_rows(periodic.repeats(documents(spark, rows))) == expected
    assert sorted_rows(periodic.repeats(clashing(documents(spark, rows)))) == expected
    assert periodic.repeats(documents(spark, [])).collect() == []


def test_query_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = [r for r in docs.collect() if len((r["text"] or "").split()) <= 250]
    found = {r["doc_id"]: tuple(r) for r in periodic.repeats(docs).collect()}
    assert len(found) == docs.count()
    assert len(short) > 50 and sum(r[1] > 0 for r in found.values()) > 10
    for r in short:
        assert found[r["doc_id"]] == plain_row(r["doc_id"], r["text"])

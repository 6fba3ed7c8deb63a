"""Token counts against a segmentation of every pre-token by itself."""

from __future__ import annotations

import random
import re

import numpy as np

import public_tokenizers
from callmeter.llm import registry, trie_counts
from tests.llm.cases import SCHEMA, awkward_rows, clashing, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VALUES = trie_counts.token_values(RANKS)
LONGEST = max(map(len, VALUES))


def best_count(word):
    """Of the segmentations of least cost the fewest tokens."""
    best = [0] + [None] * len(word)
    for end in range(1, len(word) + 1):
        options = (best[start] + VALUES[word[start:end]] for start in range(max(0, end - LONGEST), end) if word[start:end] in VALUES)
        best[end] = min(options)
    return best[-1] % (1 << 24)


def expected(rows, known={}):  # noqa: B006
    out = []
    for doc_id, text in rows:
        words = re.findall(rb"[\x09-\x0D\x20]?[^\x09-\x0D\x20]+|[\x09-\x0D\x20]", (text or "").encode())
        counts = [known[w] if w in known else known.setdefault(w, best_count(w)) for w in words]
        out.append((doc_id, len(words), sum(counts)))
    return sorted(out, key=repr)


def test_query_on_given_tables(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = registry.QUERIES["op9_token_counts"](spark, sf_dir)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_awkward_rows(spark):
    found = trie_counts.token_counts(clashing(documents(spark)), RANKS)
    assert sorted(map(tuple, found.collect()), key=repr) == expected([r[:2] for r in awkward_rows()])
    assert trie_counts.token_counts(spark.createDataFrame([], SCHEMA), RANKS).collect() == []


def test_random_bytes_and_long_words():
    rng = random.Random(3)
    words = {bytes(rng.choice(b" ab\xc3\xa9thein.-") for _ in range(rng.randrange(1, 90))) for _ in range(300)}
    words |= {b"-" * 64, b"-" * 65, b" " * 40, b"ab" * 200}
    words = sorted(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    counter = trie_counts.TrieCounter(VALUES)
    counts = counter.count(data, ends - [len(w) for w in words], ends)
    assert counts.tolist() == [best_count(w) for w in words]


def test_a_vocabulary_with_ties():
    """Of equally likely segmentations that with the fewest tokens counts."""
    unit = 1 << 24
    values = {bytes([b]): 2 * unit + 1 for b in range(256)} | {b"ab": 4 * unit + 1, b"abab": 9 * unit + 1}
    counter = trie_counts.TrieCounter(values)
    data = np.frombuffer(b"ababa", np.uint8)
    assert counter.count(data, np.array([0, 0]), np.array([4, 5])).tolist() == [2, 3]


def stretches(words):
    ends = np.cumsum([len(w) for w in words])
    return np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends


def test_long_words_share_their_prefixes():
    """Each distinct prefix of long pre-tokens is scored once, in whatever order they come."""
    rng = random.Random(5)
    stem = "数据处理引擎在许多机器上运行".encode() * 12
    words = {stem[: rng.randrange(70, len(stem))] + bytes(rng.choice(b"abc\xe4") for _ in range(rng.randrange(1, 40))) for _ in range(60)}
    words = list(words | {stem, stem[:65], stem[:66]})
    rng.shuffle(words)
    counter = trie_counts.TrieCounter(VALUES)
    assert counter.count(*stretches(words)).tolist() == [best_count(w) for w in words]
    assert counter.scored == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_short_and_long_words_agree_on_the_same_bytes():
    """The two ways through the trie give the same counts."""
    rng = random.Random(6)
    words = sorted({bytes(rng.choice(b" aethr-\xe4\xb8") for _ in range(rng.randrange(1, 65))) for _ in range(200)})
    counter = trie_counts.TrieCounter(VALUES)
    data, starts, ends = stretches(words)
    by_branches = counter._count_by_branches([data[a:b] for a, b in zip(starts, ends, strict=True)])
    assert counter.count(data, starts, ends).tolist() == by_branches.tolist()


def test_a_long_text_without_blanks(spark):
    texts = ["语言模型" * 60_000, "语言模型" * 60_000 + "尾", "a" * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in trie_counts.token_counts(docs, RANKS).collect()}
    assert found == {i: best_count(t.encode()) for i, t in enumerate(texts)}

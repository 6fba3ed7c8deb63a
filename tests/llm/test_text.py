"""Hashing of words against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from callmeter.llm.text import NOT_SPACE, Hasher, find_words, lower_ascii, n_grams, slices

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té中😀,.1", max_size=30)), min_size=1, max_size=8)


def words_of(texts, inside=None, fold=None):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    hasher = Hasher()
    for s in slices([batch]):
        yield find_words(s, hasher, inside, fold) if inside is not None else find_words(s, hasher)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_their_hashes(texts):
    hash_of: dict[str, int] = {}
    for s in words_of(texts, NOT_SPACE, lower_ascii):
        for i, text in enumerate(texts):
            expected = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
            own = range(s.first[i], s.first[i + 1])
            assert [s.data[s.starts[k] : s.ends[k]].tobytes() for k in own] == expected
            for k, word in zip(own, expected, strict=True):
                folded = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
                assert hash_of.setdefault(folded, int(s.hashes[k])) == int(s.hashes[k])
    assert len(set(hash_of.values())) == len(hash_of)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_grams_follow_the_words(texts):
    gram_of: dict[tuple, int] = {}
    for s in words_of(texts):
        grams, first = n_grams(s, 3)
        for i in range(len(texts)):
            words = s.hashes[s.first[i] : s.first[i + 1]].tolist()
            expected = [tuple(words[k : k + 3]) for k in range(len(words) - 2)] or ([tuple(words)] if words else [])
            own = grams[first[i] : first[i + 1]].tolist()
            assert len(own) == len(expected)
            for g, e in zip(own, expected, strict=True):
                assert gram_of.setdefault(e, g) == g
    assert len(set(gram_of.values())) == len(gram_of)


def test_slices_cover_long_texts():
    texts = ["a b " * 400_000, None, "c " * 900_000, "", "d"]
    found = list(words_of(texts))
    assert sum(s.rows.num_rows for s in found) == 5 and len(found) > 1
    assert sum(len(s.hashes) for s in found) == 800_000 + 900_000 + 1


def test_sliced_batches_keep_their_offsets():
    batch = pa.RecordBatch.from_pydict({"text": ["aa bb", "cc", "dd ee"]}).slice(1, 2)
    (s,) = slices([batch])
    find_words(s, Hasher())
    assert [s.data[a:b].tobytes() for a, b in zip(s.starts, s.ends, strict=True)] == [b"cc", b"dd", b"ee"]
    assert np.array_equal(s.first, [0, 1, 3])

"""Ids against the tokenizer itself, and packed sequences against their rules."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from callmeter.llm import packing, registry
from callmeter.llm.bpe import PieceTable
from callmeter.llm.text import slices
from tests.llm.cases import SCHEMA, awkward_rows, clashing, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def ids_of(texts, table=None):
    table = table or PieceTable(RANKS, public_tokenizers.PATTERN)
    return [x.tolist() for s in slices([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})]) for x in table.encode(s)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'sTtdlverm \n\t.,!1²é中😀　 ﬁ", max_size=25), max_size=6))
def test_ids_equal_the_tokenizers(tokenizer, texts):
    assert ids_of(texts) == [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_ids_of_given_documents(spark, sf_dir, tokenizer):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += ["<|endoftext|> as text", "x'S 'tis they'll 'sfoo", "  \n \n  a  "]
    assert ids_of(texts) == [e.ids + [0] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_special_tokens_stand_for_themselves(spark):
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, f"{end}{end}", f" x {end}  y's{end}", "plain", "<|endoftext|", "", f"é{end}\n\n{end} z", "a <|endoftext|>" * 50]
    table = PieceTable(RANKS, public_tokenizers.PATTERN, packing.SPECIAL)
    assert ids_of(texts, table) == [e.ids + [0] for e in named.encode_batch(texts, add_special_tokens=False)]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    rows = packing.pack_documents(docs, RANKS, public_tokenizers.PATTERN).collect()
    check_sequences(rows, dict(enumerate(texts)), named)


def test_forgetting_pieces_changes_nothing(monkeypatch):
    from callmeter.llm import bpe

    texts = [f"some words {i} and {i * 7} more" for i in range(50)]
    expected = ids_of(texts)
    monkeypatch.setattr(bpe, "_REMEMBERED", 3)
    table = PieceTable(RANKS, public_tokenizers.PATTERN)
    assert [ids_of([t], table)[0] for t in texts] == expected


def check_sequences(rows, texts, tokenizer):
    """Every id in one piece, pieces gapless within sequences of at most 1,024."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for (doc_id, total), pieces in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert total == len(ids)
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == total
    assert {d for d, _ in by_doc} == set(texts)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    return sum(r["length"] for r in rows) / 1024 / len(by_sequence)


def test_query_on_given_tables(spark, sf_dir, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.QUERIES["op3_packing"](spark, sf_dir).collect()
    assert check_sequences(rows, texts, tokenizer) > 0.98


def test_awkward_rows(spark, tokenizer):
    unique = [r for r in dict.fromkeys(awkward_rows()) if r[1:] != (None,) * 4]
    docs = clashing(documents(spark, unique))
    rows = packing.pack_documents(docs, RANKS, public_tokenizers.PATTERN).collect()
    check_sequences(rows, {r[0]: r[1] for r in unique}, tokenizer)
    repeated = documents(spark, [(1, "same", None, None, None)] * 3 + [(None, None, None, None, None)])
    rows = packing.pack_documents(repeated, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (1, 2), (1, 2), (1, 2)]
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), RANKS, public_tokenizers.PATTERN).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 128), max_size=120), st.integers(1, 12))
def test_differencing_keeps_every_piece(sizes, k):
    parts = packing.difference(sizes, k)
    assert len(parts) <= k and sorted(i for p in parts for i in p) == list(range(len(sizes)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 128), min_size=1, max_size=200))
def test_windows_hold_their_capacity(sizes):
    parts = packing.pack(sizes, 128)
    assert max(sum(sizes[i] for i in p) for p in parts) <= 128
    assert sorted(i for p in parts for i in p) == list(range(len(sizes)))


def test_windows_are_near_equal():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 129) for _ in range(4000)]
    parts = packing.difference(sizes, 260)
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert len(parts) == 260 and max(sums) - min(sums) <= 4

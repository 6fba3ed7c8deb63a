"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

A document's ids end with id 0. Full windows are cut off its front; the rest
is cut into pieces of at most ``PIECE`` ids. The pieces of some hundred
windows at a time are divided among them: every piece starts as a partial
partition, and the two partitions of largest imbalance are merged, the fullest
windows of one with the emptiest of the other, until one is left. Where a
window of it exceeds the capacity, one window is added and the pieces are
divided again.

Each task packs its own rows, so nothing is shuffled. Null texts are empty,
empty texts are the id 0 alone, repeated rows are packed each. Sequence ids
are unique, and the same again if a task is repeated on the same rows. An empty
table gives no pieces.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from callmeter.llm.bpe import PieceTable
from callmeter.llm.text import slices

# Fixed value: the special token of the vocabulary.
SPECIAL = {"<|endoftext|>": 50256}
CAPACITY = 1024
PIECE = 128
# Windows divided at a time.
GROUP = 256
_NAMES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """The numbers of ``sizes`` in ``k`` parts of near-equal sums; empty parts are left out.

    A partition is the list of its non-empty parts, fullest first, as minus
    their sum and the number of a tree of members.
    """
    joined: list[tuple] = [(i,) for i in range(len(sizes))]
    ties = itertools.count()
    heap = [(-size, next(ties), [(-size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(b) > len(a):
            a, b = b, a
        # The emptiest parts of a, those without members among them, take the fullest of b.
        merged, open_parts = a[: k - len(b)], a[k - len(b) :]
        rising = b[::-1]
        for (x, left), (y, right) in zip(open_parts, rising, strict=False):
            merged.append((x + y, len(joined)))
            joined.append((left, right))
        merged += rising[len(open_parts) :]
        merged.sort()
        imbalance = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (imbalance, next(ties), merged))
    parts = []
    for _, tree in heap[0][2] if heap else ():
        members, todo = [], [tree]
        while todo:
            node = joined[todo.pop()]
            if len(node) == 1:
                members.append(node[0])
            else:
                todo.extend(node)
        parts.append(sorted(members))
    return parts


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Parts of sums of at most ``capacity``, as few as differencing finds from the least number on."""
    k = max(1, -(-sum(sizes) // capacity))
    while sizes:
        parts = difference(sizes, k)
        if max(sum(sizes[i] for i in part) for part in parts) <= capacity:
            return parts
        k += 1
    return []


def cut(length: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full windows, then smaller ones."""
    tail = length - length % capacity
    full = [(at, capacity) for at in range(0, tail, capacity)]
    return full + [(at, min(piece, length - at)) for at in range(tail, length, piece)]


def pack_documents(
    docs: DataFrame, ranks: str, pattern: str, capacity: int = CAPACITY, special: dict[str, int] | None = SPECIAL
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    ``ranks`` is the path of a byte-level BPE vocabulary that executors can
    read, and ``pattern`` what splits texts for it; ``special`` are the tokens
    that stand for themselves in a text. An empty table has no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(ranks, pattern, special)
        sequence = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []
        size = 0

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(list(c), pa.int64()) for c in zip(*(r[1:] for r in rows), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], id_type), *columns], names=["doc_id", *_NAMES])

        def divided() -> list[tuple]:
            nonlocal sequence
            rows = []
            for part in pack([w[2] for w in waiting], capacity):
                offset = 0
                for i in part:
                    rows.append((*waiting[i], sequence, offset))
                    offset += waiting[i][2]
                sequence += 1
            return rows

        id_type = None
        for s in slices(batches, "__text"):
            ids = s.rows.column(0).to_pylist()
            id_type = s.rows.column(0).type
            rows: list[tuple] = []
            for doc_id, tokens in zip(ids, table.encode(s), strict=True):
                for start, length in cut(len(tokens), capacity):
                    crc = zlib.crc32(tokens[start : start + length].tobytes())
                    if length == capacity:
                        rows.append((doc_id, start, length, crc, len(tokens), sequence, 0))
                        sequence += 1
                    else:
                        waiting.append((doc_id, start, length, crc, len(tokens)))
                        size += length
                if size >= GROUP * capacity:
                    rows.extend(divided())
                    waiting, size = [], 0
            if rows:
                yield emit(rows)
        if waiting:
            yield emit(divided())

    rows = docs.select("doc_id", F.col("text").alias("__text"))
    schema = StructType([rows.schema.fields[0], *(StructField(n, LongType()) for n in _NAMES)])
    return rows.mapInArrow(run, schema)

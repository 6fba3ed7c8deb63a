"""Token counts under a unigram model, with one pass over a trie of distinct pre-tokens.

A pre-token begins at every white-space byte and at the start of a text, so
that a word takes the white space before it along. The vocabulary is one of
byte strings that holds every single byte; a token's probability follows
Zipf's law on its rank. Of all segmentations of a pre-token the likeliest
counts, and of equally likely ones that with the fewest tokens.

Distinct pre-tokens are put in a trie. The best score of a prefix is computed
once, at its node, from the nodes above it, and the node where a pre-token ends
holds its count. Short pre-tokens are taken level by level, all of them at
once; those of any greater length branch by branch, in the order of their
bytes, so that each goes on from the node where it leaves the one before.
Scores are whole numbers, so that ties are exact.

Null and empty texts have no pre-tokens and count 0; repeated rows count each;
an empty table gives no rows.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from callmeter.llm.linear import row_sums
from callmeter.llm.text import Hasher, Slice, byte_set, slices

# A path's value is its cost above these bits and its tokens in them.
_COUNT_BITS = 24
_COST_UNIT = 1 << 12
# Pre-tokens up to this length are taken level by level, longer ones branch by branch: a level of few nodes
# costs as much as one of many, and a text without blanks has a level per byte.
_DEEPEST = 64
_REMEMBERED = 1 << 20
_FILTER_BITS = 22
_FAR = np.int64(1) << 62
_NONE = int(_FAR)
_WHITE = byte_set(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)


def token_values(path: str) -> dict[bytes, int]:
    """For each token of a ranked vocabulary the value of taking it: its cost, and one token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    norm = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {t: (round((math.log(r + 1) + norm) * _COST_UNIT) << _COUNT_BITS) + 1 for t, r in ranks.items()}


class TrieCounter:
    """Counts tokens of distinct pre-tokens. One per task."""

    def __init__(self, values: dict[bytes, int]):
        self._values = values
        self._hasher = Hasher()
        self._backward: dict | None = None
        # Nodes of long pre-tokens scored so far.
        self.scored = 0
        tokens = list(values)
        data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        starts = ends - np.array([len(t) for t in tokens])
        keys = self._hasher.span(self._hasher.prefix(data), starts, ends)
        order = np.argsort(keys)
        self._keys = keys[order]
        self._value = np.array([values[t] for t in tokens], dtype=np.int64)[order]
        self._lengths = sorted({len(t) for t in tokens})
        self._filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self._filter[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def _lookup(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The values of the byte strings that are tokens, elsewhere a value beyond all."""
        keys = self._hasher.span(sums, starts, ends)
        out = np.full(len(keys), _FAR)
        maybe = np.flatnonzero(self._filter[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self._keys, keys[maybe]), len(self._keys) - 1)
        real = self._keys[at] == keys[maybe]
        out[maybe[real]] = self._value[at[real]]
        return out

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each of the given stretches, which should be distinct."""
        counts = np.zeros(len(starts), dtype=np.int64)
        long = ends - starts > _DEEPEST
        if long.any():
            counts[long] = self._count_by_branches([data[a:b] for a, b in zip(starts[long], ends[long], strict=True)])
        active = np.flatnonzero(~long)
        sums = self._hasher.prefix(data)
        node = np.zeros(len(active), dtype=np.int64)
        best = [np.zeros(1, dtype=np.int64)]
        parents: list[np.ndarray] = [np.zeros(1, dtype=np.int64)]
        depth = 0
        while len(active):
            depth += 1
            going = starts[active] + depth <= ends[active]
            active, node = active[going], node[going]
            if not len(active):
                break
            # The children of the level's nodes: one per parent and byte.
            edges = node * 256 + data[starts[active] + depth - 1]
            edges, sample, node = np.unique(edges, return_index=True, return_inverse=True)
            place = starts[active[sample]]
            value = np.full(len(edges), _FAR)
            above = edges // 256
            parents.append(above)
            for size in range(1, depth + 1):
                if size > 1:
                    above = parents[depth - size + 1][above]
                if size in self._lengths:
                    step = self._lookup(sums, place + depth - size, place + depth)
                    value = np.minimum(value, np.where(step < _FAR, best[depth - size][above] + step, _FAR))
            best.append(value)
            done = starts[active] + depth == ends[active]
            counts[active[done]] = value[node[done]] & ((1 << _COUNT_BITS) - 1)
        return counts

    def _tokens_backward(self) -> dict:
        """The vocabulary as a trie of reversed tokens; where a token is whole, its cost is at -1."""
        if self._backward is None:
            self._backward = {}
            for token, value in self._values.items():
                at = self._backward
                for b in reversed(token):
                    at = at.setdefault(b, {})
                at[-1] = value >> _COUNT_BITS
        return self._backward

    def _count_by_branches(self, words: list[np.ndarray]) -> np.ndarray:
        """Tokens of each pre-token; what one shares with the one before it in order is not scored again."""
        root = self._tokens_backward()
        counts = np.zeros(len(words), dtype=np.int64)
        cost, tokens = array("q", [0]), array("q", [0])
        before = np.zeros(0, dtype=np.uint8)
        for i in sorted(range(len(words)), key=lambda i: words[i].tobytes()):
            word = words[i]
            size = min(len(word), len(before))
            differ = np.flatnonzero(word[:size] != before[:size])
            shared = int(differ[0]) if len(differ) else size
            del cost[shared + 1 :], tokens[shared + 1 :]
            listed = word.tobytes()
            for end in range(shared + 1, len(word) + 1):
                at, begin, least, fewest = root, end, _NONE, 0
                while begin and (at := at.get(listed[begin - 1])) is not None:
                    begin -= 1
                    if -1 in at:
                        total, number = cost[begin] + at[-1], tokens[begin] + 1
                        if total < least or (total == least and number < fewest):
                            least, fewest = total, number
                cost.append(least)
                tokens.append(fewest)
                self.scored += 1
            counts[i] = tokens[-1]
            before = word
        return counts


def pre_tokens(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of a slice, and the first one of each row."""
    if len(s.data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(s.offsets), np.int64)
    opens = np.zeros(len(s.data) + 1, dtype=bool)
    opens[:-1] = _WHITE[s.data]
    opens[s.offsets] = True
    starts = np.flatnonzero(opens[:-1])
    return starts, np.append(starts[1:], len(s.data)), np.searchsorted(starts, s.offsets)


def token_counts(docs: DataFrame, ranks: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_pre_tokens and n_tokens.

    ``ranks`` is the path of a ranked byte vocabulary that executors can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, hasher = TrieCounter(token_values(ranks)), Hasher()
        known: dict[int, int] = {}
        for s in slices(batches, "__text"):
            starts, ends, first = pre_tokens(s)
            hashes = hasher.span(hasher.prefix(s.data), starts, ends)
            keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
            if len(known) > _REMEMBERED:
                known = {}
            listed = keys.tolist()
            new = at[[k for k, key in enumerate(listed) if key not in known]] if len(listed) else at
            known.update(zip(hashes[new].tolist(), counter.count(s.data, starts[new], ends[new]).tolist(), strict=True))
            counts = np.array([known[key] for key in listed], dtype=np.int64)[which]
            total = row_sums(counts, first).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0), pa.array(np.diff(first)), pa.array(total)], names=["doc_id", "n_pre_tokens", "n_tokens"]
            )

    rows = docs.select("doc_id", F.col("text").alias("__text"))
    added = [StructField("n_pre_tokens", LongType()), StructField("n_tokens", LongType())]
    return rows.mapInArrow(run, StructType([rows.schema.fields[0], *added]))

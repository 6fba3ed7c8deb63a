"""Language model: hashed maximum entropy with a class-factored softmax.

Tokens are runs of bytes that are no ASCII white space, A to Z in lower case,
and one end per text. A token's probability is that of its class given the
two tokens before it, times its own within the class:

* The most frequent words form the head, in classes of like frequency. Within
  a class a second softmax, on the token before, picks the word.
* All other words belong to classes by a hash of their ending. Within a class
  a known word starts from a share by its count, and each pair of a hashed
  context (the token before, in 65,536 buckets) and such a word that the
  documents hold twice or more has a weight of its own. These weights are a
  table that grows with the corpus, as the counts do: the most frequent are
  broadcast, all others joined. The share of words never seen, one type for
  all, is that of the tokens seen once (Good-Turing).
* The end is a class of its own.

The class softmax starts from the classes' counts after each hashed context
(all tokens outside the tail are one count there) and has a weight row for the token before the last (skip) and for the hashed
pair of both. Its weights, and those within the head's classes, are
trained by gradient steps, round by round: documents are dealt to shards by a
hash, as many as their tokens ask for, so that the model does not depend on how
files are laid out; each task walks over its shard from the shared weights, and
the shards' weights are averaged by their number of tokens.

No two pair weights act on one token, so their gradients vanish in closed form:
after context b a word w of class c gets the probability
(n(b, w) - d) / N(b, c) + r(b, c) p(w), where d is an absolute discount and r
the mass that discounts and pairs seen once leave over. As a log-linear model
that is log p(w) + log r(b, c) + weight(b, w), a sum of three looked up numbers.
Counts are taken over all documents learned from.

Probabilities of all known words, the end and the unknown type sum to one.
Null texts are empty: they hold only an end. Without documents to learn from
every token is the unknown type, whose probability is one. Repeated rows count
and are scored each, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from callmeter.llm.linear import id_remainder, row_sums
from callmeter.llm.text import NOT_SPACE, Hasher, Slice, find_words, lower_ascii, mix, release_memory, slices
from callmeter.operators.durable import cut_lineage

_U = np.uint64
HEAD_CLASSES, CLASS_WORDS, TAIL_CLASSES = 16, 32, 32
HEAD = HEAD_CLASSES * CLASS_WORDS
CLASSES = HEAD_CLASSES + TAIL_CLASSES + 1
END_CLASS = CLASSES - 1
# A constant that no word has as key: its class bits say 0, its hash bits are fixed.
END_KEY = _U(0x9E3779B97F4A7C00)
# Buckets of a token as context: head words, other words by class and four bits of hash, the start.
BUCKETS = HEAD + 16 * TAIL_CLASSES + 1
START = BUCKETS - 1
PAIRS = 2048
ROWS = BUCKETS + PAIRS
HEAD_CONTEXTS = 128
# Hashed contexts of the pair weights; the start of a text shares the first.
CONTEXT_BITS = 16
# Occurrences from which a pair has a weight of its own.
LEAST_PAIR = 2
# Tokens' worth of the classes' overall shares in the counts after a context.
CLASS_PRIOR = 4.0
ROUNDS = 2
# Tokens in a shard of a round, about, and the fewest shards.
SHARD_TOKENS = 1 << 22
SHARDS = 4
# Words whose counts, and pairs whose weights, are broadcast; those of all others are joined.
FREQUENT = 1 << 17
# Tokens counted before their counts are handed on.
_COUNTED = 1 << 22
# Tokens of a bucket of pairs, about; lookups held before they are handed on.
_BUCKET_TOKENS = 1 << 22
_LOOKUPS = 1 << 21
_STEP = 8192
_RATE = 0.25
_REDUCERS = 32


@dataclass
class Tokens:
    """The tokens of a slice, row after row, each row closed by its end."""

    keys: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def tokens(s: Slice, hasher: Hasher) -> Tokens:
    """Keys: a word's hash, with its class among the tail classes in the low five bits."""
    find_words(s, hasher, NOT_SPACE, lower_ascii)
    rows = len(s.first) - 1
    first = s.first + np.arange(rows + 1)
    keys = np.full(first[-1], END_KEY, dtype=_U)
    if len(s.starts):
        last = lower_ascii(s.data[s.ends - 1]).astype(_U)
        before = np.where(s.ends - s.starts > 1, lower_ascii(s.data[np.maximum(s.ends - 2, 0)]), 0).astype(_U)
        ending = mix(last * _U(256) + before + _U(1)) & _U(TAIL_CLASSES - 1)
        words = (s.hashes & ~_U(TAIL_CLASSES - 1)) | ending
        keys[np.arange(len(words)) + s.row_of_word()] = words
    return Tokens(keys, first)


def hashed_contexts(t: Tokens) -> np.ndarray:
    """The bucket of the token before each token; 0 at the start of a row."""
    bucket = ((t.keys >> _U(40)) & _U((1 << CONTEXT_BITS) - 1)).astype(np.int32)
    before = np.zeros(len(bucket), np.int32)
    before[1:] = bucket[:-1]
    before[t.first[:-1]] = 0
    return before


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One key for a context and a word: five bits of its class, 43 more bits of the word, 16 of the context.

    In order of these keys the pairs of a class, and in it of a word, stand together.
    """
    ending, rest = words & _U(31), words >> _U(5) & _U((1 << 43) - 1)
    return ending << _U(59) | rest << _U(16) | before.astype(_U)


def bucket_bits(total: int) -> int:
    """How many leading bits of the keys tell buckets apart: those of the class at least, more for a larger corpus."""
    return 5 + max(0, (total // (_BUCKET_TOKENS << 5)).bit_length())


def _packed(x: np.ndarray) -> bytes:
    """Numbers as bytes, all their first bytes together and so on, so that leading zeros shrink when compressed."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _unpacked(data: pa.Scalar, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(data.as_buffer(), np.uint8).reshape(width, -1) if data.is_valid else np.zeros((width, 0), np.uint8)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Keys in order, by their differences."""
    return _packed(np.diff(keys, prepend=_U(0)))


def _unpacked_keys(data: pa.Scalar) -> np.ndarray:
    return np.cumsum(_unpacked(data, _U), dtype=_U)


def _bounds(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket among ascending ones and its stretch."""
    first = np.flatnonzero(np.diff(buckets.astype(np.int64), prepend=-1))
    for low, high in zip(first, [*first[1:], len(buckets)], strict=True):
        yield int(buckets[low]), slice(low, high)


def _find(ordered: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands among ``ordered``, and whether it is there at all."""
    if len(ordered) == 0:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return at, ordered[at] == keys


def _counts(docs: DataFrame) -> DataFrame:
    """Rows (word, n): how often each token occurs in ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _counted(batches, lambda t: t.keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(batches: Iterator[pa.RecordBatch], key) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys of tokens, in order, and how often they occur."""
    hasher, held, size = Hasher(), [], 0
    for s in slices(batches):
        held.append(key(tokens(s, hasher)))
        size += len(held[-1])
        if size >= _COUNTED:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


_OTHER = pair_keys(np.zeros(1, np.int32), np.array([END_KEY]))[0] >> _U(16)


def _folded(keys: list, n: list) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[new], np.add.reduceat(n, new)


def _pairs(docs: DataFrame, head: np.ndarray, bits: int) -> DataFrame:
    """What the documents hold of pairs of a hashed context and a word, a row per bucket.

    Columns: the pairs that occur often enough with their counts and those of
    their words; per context the tokens of the bucket's class (head words and
    ends: a class of their own) and the sum and number of such pairs; the
    number of pairs that occur once and twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def key(t: Tokens) -> np.ndarray:
            return pair_keys(hashed_contexts(t), np.where(_find(head, t.keys)[1], END_KEY, t.keys))

        for keys, n in _counted(batches, key):
            for bucket, part in _bounds(keys >> _U(64 - bits)):
                yield pa.RecordBatch.from_pylist(
                    [{"bucket": bucket, "keys": _packed_keys(keys[part]), "n": _packed(n[part])}], pa.schema(counted)
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, keys, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                own = held.setdefault(bucket, [[], [], 0])
                own[0].append(_unpacked_keys(keys))
                own[1].append(_unpacked(n, np.int64))
                own[2] += len(own[0][-1])
                if own[2] > 2 * len(own[0][0]) + _COUNTED:
                    keys, n = _folded(own[0], own[1])
                    held[bucket] = [[keys], [n], len(keys)]
        for bucket in list(held):
            yield summary(bucket, *_folded(*held.pop(bucket)[:2]))

    def summary(bucket: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        word = keys >> _U(16)
        new = np.flatnonzero(np.diff(word, prepend=~word[:1]))
        of_word = np.repeat(np.add.reduceat(n, new), np.diff(np.append(new, len(word))))
        other = word == _OTHER
        often = (n >= LEAST_PAIR) & ~other
        cell = (keys & _U(0xFFFF)).astype(np.int64) + (other.astype(np.int64) << CONTEXT_BITS)
        sums = [np.bincount(cell, x, 2 << CONTEXT_BITS) for x in (n, n * often, often)]
        at = np.flatnonzero(sums[0])
        row = {
            "bucket": bucket,
            "class": bucket >> (bits - 5),
            "keys": _packed_keys(keys[often]),
            "n": _packed(n[often]),
            "of_word": _packed(of_word[often]),
            "cells": _packed(at),
            **{name: _packed(x[at]) for name, x in zip(("total", "held", "pairs"), sums, strict=True)},
            "once": int(((n == 1) & ~other).sum()),
            "twice": int(((n == 2) & ~other).sum()),
        }
        return pa.RecordBatch.from_pylist([row], pa.schema(merged))

    counted = [("bucket", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())]
    blobs = [(name, pa.binary()) for name in ("keys", "n", "of_word", "cells", "total", "held", "pairs")]
    merged = [("bucket", pa.int32()), ("class", pa.int32()), *blobs, ("once", pa.int64()), ("twice", pa.int64())]
    found = docs.select("text").mapInArrow(run, "bucket int, keys binary, n binary").repartition(1 << bits, "bucket")
    columns = ", ".join(f"{name} binary" for name, _ in blobs)
    return found.mapInArrow(merge, f"bucket int, class int, {columns}, once long, twice long")


class Contexts:
    """What followed each hashed context: counts that travel compressed, and the tables that follow from them."""

    def __init__(self, share: np.ndarray, discount: float, total: np.ndarray, held: np.ndarray, pairs: np.ndarray):
        """The classes' shares, what is taken off a pair's count, and per context and tail class (and one for all
        other tokens) the tokens, the sum of the counts of the pairs with a weight, and their number."""
        self._share, self._discount, self._shares, self._left = share, discount, None, None
        self._counts = [zstandard.compress(_packed(x.astype(np.int64).ravel())) for x in (total, held, pairs)]

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_shares": None, "_left": None}

    def _count(self, k: int) -> np.ndarray:
        planes = np.frombuffer(zstandard.decompress(self._counts[k]), np.uint8).reshape(8, -1)
        return np.ascontiguousarray(planes.T).view(np.int64).reshape(-1, TAIL_CLASSES + 1)

    def shares(self) -> np.ndarray:
        """Log shares of the classes after each context."""
        if self._shares is None:
            # The classes of the head and the end share their tokens after a context as they do overall.
            n, share, in_tail = self._count(0), self._share, slice(HEAD_CLASSES, END_CLASS)
            other = share.copy()
            other[in_tail] = 0
            chance = n[:, -1:] * (other / max(other.sum(), 1e-300)) + CLASS_PRIOR * share
            chance[:, in_tail] += n[:, :-1]
            chance /= n.sum(axis=1, keepdims=True) + CLASS_PRIOR
            np.log(np.maximum(chance, 1e-30, out=chance), out=chance)
            self._shares = chance.astype(np.float32)
            self._shares[:, share < 1e-300] = -1e4
        return self._shares

    def left(self) -> tuple[np.ndarray, np.ndarray]:
        """Per context and tail class: log10 of what pairs leave over, and the tokens."""
        if self._left is None:
            n = self._count(0)[:, :-1]
            kept = self._count(1)[:, :-1] - self._discount * self._count(2)[:, :-1]
            kept /= np.maximum(n, 1)
            self._left = np.log10(1 - kept).astype(np.float32), n.astype(np.float32)
        return self._left


@dataclass
class Model:
    """What the executors need to train and score; all of bounded size."""

    total: int
    distinct: int
    ends: int
    frequent: np.ndarray
    frequent_n: np.ndarray
    head: np.ndarray
    head_slot: np.ndarray
    head_log: np.ndarray
    prior: np.ndarray
    mass: np.ndarray
    unseen: np.ndarray
    weights: np.ndarray
    head_weights: np.ndarray
    contexts_seen: Contexts | None
    pair: np.ndarray
    pair_weight: np.ndarray
    discount: float
    bits: int

    @property
    def class_log(self) -> np.ndarray:
        return self.contexts_seen.shares()

    @property
    def left_log(self) -> np.ndarray:
        return self.contexts_seen.left()[0]

    @property
    def after(self) -> np.ndarray:
        return self.contexts_seen.left()[1]

    def head_number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each head word, -1 for others."""
        if len(self.head) == 0:
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.head, keys), len(self.head) - 1)
        return np.where(self.head[at] == keys, self.head_slot[at], -1)

    def contexts(self, t: Tokens, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The weight rows of each token (the one before the last, the pair), the last one's bucket and its hashed context."""
        bucket = np.where(number >= 0, number, HEAD + (t.keys & _U(16 * TAIL_CLASSES - 1)).astype(np.int64))
        one = np.empty(len(bucket), np.int64)
        two = np.empty(len(bucket), np.int64)
        one[1:], two[2:] = bucket[:-1], bucket[:-2]
        begin = t.first[:-1]
        one[begin], two[begin] = START, START
        second = begin + 1
        two[second[second < t.first[1:]]] = START
        pair = (one * 40503 + two * 30011) % 65521 % PAIRS
        return two, pair + BUCKETS, one, hashed_contexts(t)

    def classes(self, t: Tokens, number: np.ndarray) -> np.ndarray:
        tail = HEAD_CLASSES + (t.keys & _U(TAIL_CLASSES - 1)).astype(np.int64)
        return np.where(t.keys == END_KEY, END_CLASS, np.where(number >= 0, number // CLASS_WORDS, tail))

    def pair_weights(self, keys: np.ndarray, n: np.ndarray, of_word: np.ndarray) -> np.ndarray:
        """log10 of how much likelier a pair makes its word, from its count and its word's."""
        before, label = (keys & _U(0xFFFF)).astype(np.int64), (keys >> _U(59)).astype(np.int64)
        start = (of_word + 0.1) / self.mass[HEAD_CLASSES + label] * 10.0 ** self.left_log[before, label]
        return np.log10(1 + (n - self.discount) / self.after[before, label] / start)

    def class_logits(self, rows: tuple, part: slice) -> np.ndarray:
        z = np.take(self.class_log, rows[3][part], axis=0)
        z += np.take(self.weights, rows[0][part], axis=0)
        z += np.take(self.weights, rows[1][part], axis=0)
        return z


def _probabilities(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _most_frequent(rows: DataFrame) -> DataFrame:
    """The rows of the highest counts ``n``, at most ``FREQUENT``: whole levels of like counts."""
    level = F.floor(F.log2("n") * 16).cast("int").alias("level")
    sizes = {r["level"]: r["count"] for r in rows.groupBy(level).count().collect()}
    lowest, held = 1 << 30, 0
    for k in sorted(sizes, reverse=True):
        held += sizes[k]
        if held > FREQUENT:
            break
        lowest = k
    return rows.filter(level >= lowest)


def _statistics(counts: DataFrame) -> Model:
    """The untrained model: counts, classes, priors and shares, and weights of zero."""
    word_class = F.col("word").bitwiseAND(TAIL_CLASSES - 1).alias("class")
    is_end = F.col("word") == int(END_KEY.view(np.int64))
    totals = counts.filter(~is_end).groupBy(word_class).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once")
    )
    totals = totals.toPandas()
    ends = counts.filter(is_end).agg(F.sum("n")).first()[0] or 0
    frequent = _most_frequent(counts.filter(~is_end)).toPandas()
    keys = frequent["word"].to_numpy(dtype=np.int64).view(_U)
    order = np.argsort(keys)
    keys, n = keys[order], frequent["n"].to_numpy(dtype=np.int64)[order]
    rank = np.lexsort((keys, -n))[:HEAD]
    slot = np.empty(len(rank), np.int64)
    by_key = np.argsort(keys[rank])
    slot[:] = by_key
    head_log = np.full(HEAD, -30.0, dtype=np.float32)
    head_log[: len(rank)] = np.log(n[rank])
    in_head = np.zeros(TAIL_CLASSES)
    in_head_words = np.zeros(TAIL_CLASSES)
    once_in_head = np.zeros(TAIL_CLASSES)
    head_class = (keys[rank] & _U(TAIL_CLASSES - 1)).astype(int)
    np.add.at(in_head, head_class, n[rank])
    np.add.at(in_head_words, head_class, 1)
    np.add.at(once_in_head, head_class, n[rank] == 1)
    sums = totals.groupby("class")[["n", "words", "once"]].sum().reindex(range(TAIL_CLASSES), fill_value=0)
    tail_n = np.maximum(0, sums["n"].to_numpy(dtype=float) - in_head)
    tail_words = np.maximum(0, sums["words"].to_numpy(dtype=float) - in_head_words)
    once = np.maximum(0, sums["once"].to_numpy(dtype=float) - once_in_head)
    unseen = np.zeros(CLASSES)
    unseen[HEAD_CLASSES:END_CLASS] = np.where(tail_words > 0, (once + 0.5) / (tail_n + 1), 1.0)
    mass = np.ones(CLASSES)
    mass[HEAD_CLASSES:END_CLASS] = np.maximum(tail_n + 0.1 * tail_words, 0.1)
    size = np.zeros(CLASSES)
    np.add.at(size, np.arange(len(rank)) // CLASS_WORDS, n[rank])
    # A class without words keeps a little, but for those of the head.
    size[HEAD_CLASSES:END_CLASS] = tail_n + 0.5
    size[END_CLASS] = ends
    prior = np.where(size > 0, np.log(np.maximum(size, 1e-9)), -1e4).astype(np.float32)
    return Model(
        total=int(totals["n"].sum()) + int(ends),
        distinct=int(totals["words"].sum()) + (ends > 0),
        ends=int(ends),
        frequent=keys,
        frequent_n=n,
        head=keys[rank][by_key],
        head_slot=slot,
        head_log=head_log.reshape(HEAD_CLASSES, CLASS_WORDS),
        prior=prior - np.float32(np.log(max(size.sum(), 1))),
        mass=mass,
        unseen=unseen,
        weights=np.zeros((ROWS, CLASSES), np.float32),
        head_weights=np.zeros((HEAD_CONTEXTS * HEAD_CLASSES, CLASS_WORDS), np.float32),
        contexts_seen=None,
        pair=np.zeros(0, _U),
        pair_weight=np.zeros(0, np.float32),
        discount=0.0,
        bits=5,
    )


def _add_pairs(model: Model, pairs: DataFrame) -> None:
    """Fill in what ``model`` holds of the pairs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                own = sums.setdefault(batch.column(0)[row].as_py(), np.zeros((3, 2 << CONTEXT_BITS)))
                cells = _unpacked(batch.column(1)[row], np.int64)
                for k in range(3):
                    own[k, cells] += _unpacked(batch.column(2 + k)[row], np.float64)
        for label, own in sums.items():
            cells = np.flatnonzero(own[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cells), label, np.int32)), pa.array(cells), *map(pa.array, own[:, cells])], names=names
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                columns = [_unpacked_keys(batch.column(0)[row]).view(np.int64)]
                columns += [_unpacked(batch.column(k)[row], np.int64) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["pair", "n", "of_word"])

    names = ["class", "cell", "total", "held", "pairs"]
    low = pairs.agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).first()
    once, twice = low["once"] or 0, low["twice"] or 0
    model.discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    # At most one row per context and class: 65,536 x 33.
    cells = pairs.select("class", "cells", "total", "held", "pairs").repartition(TAIL_CLASSES, "class")
    table = cells.mapInArrow(add, "class int, cell long, total double, held double, pairs double").toArrow()
    cell, label = table["cell"].to_numpy(), table["class"].to_numpy()
    label = np.where(cell >> CONTEXT_BITS, TAIL_CLASSES, label)
    before = cell & ((1 << CONTEXT_BITS) - 1)
    seen = np.zeros((3, 1 << CONTEXT_BITS, TAIL_CLASSES + 1))
    for k, name in enumerate(names[2:]):
        np.add.at(seen[k], (before, label), table[name].to_numpy())
    share = np.exp(model.prior.astype(np.float64))
    model.contexts_seen = Contexts(share / share.sum(), model.discount, *seen)
    del table, cell, label, before, seen
    release_memory()
    listed = pairs.select("keys", "n", "of_word").mapInArrow(rows, "pair long, n long, of_word long")
    frequent = _most_frequent(listed).toArrow()
    keys = frequent["pair"].to_numpy().view(_U)
    order = np.argsort(keys)
    model.pair = keys[order]
    weights = model.pair_weights(keys, frequent["n"].to_numpy(), frequent["of_word"].to_numpy())
    model.pair_weight = weights[order].astype(np.float32)


def _descend(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """One step of adaptive gradient descent on the weight rows of a batch."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    at = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    own = rows[at]
    step = np.add.reduceat(np.take(gradient, order, axis=0), at, axis=0)
    squares[own] += step * step
    weights[own] -= _RATE * step / np.sqrt(squares[own])


class Trainer:
    def __init__(self, model: Model):
        self.model = model
        self._squares = np.ones_like(model.weights)
        self._head_squares = np.ones_like(model.head_weights)
        self.seen = 0

    def learn(self, t: Tokens) -> None:
        m = self.model
        number = m.head_number(t.keys)
        rows = m.contexts(t, number)
        label = m.classes(t, number)
        self.seen += len(label)
        for low in range(0, len(label), _STEP):
            part = slice(low, low + _STEP)
            gradient = _probabilities(m.class_logits(rows, part))
            gradient[np.arange(len(gradient)), label[part]] -= 1
            for group in rows[:2]:
                _descend(m.weights, self._squares, group[part], gradient)
            head = np.flatnonzero(number[part] >= 0)
            if len(head):
                word = number[part][head]
                where = head_rows(rows[2][part][head], word)
                inner = _probabilities(m.head_log[word // CLASS_WORDS] + m.head_weights[where])
                inner[np.arange(len(word)), word % CLASS_WORDS] -= 1
                _descend(m.head_weights, self._head_squares, where, inner)


def head_rows(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return before % HEAD_CONTEXTS * HEAD_CLASSES + word // CLASS_WORDS


def _round(docs: DataFrame, model: Model) -> None:
    """One round of distributed gradient steps; changes the weights of ``model``."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))
    shape = model.weights.size

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        start = own.weights, own.head_weights
        own.weights, own.head_weights = own.weights.copy(), own.head_weights.copy()
        trainer, hasher = Trainer(own), Hasher()
        for s in slices(batches):
            trainer.learn(tokens(s, hasher))
        if trainer.seen:
            change = np.concatenate([(own.weights - start[0]).ravel(), (own.head_weights - start[1]).ravel()])
            yield _change(trainer.seen, change.astype(np.float16))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = 0, None
        for batch in batches:
            for n, change in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                step = np.frombuffer(change.as_buffer(), np.float16).astype(np.float64) * n
                total = step if total is None else total + step
                seen += n
        if seen:
            yield _change(seen, (total / seen).astype(np.float32))

    schema = "seen long, change binary"
    changes = docs.select("text").mapInArrow(train, schema).repartition(_REDUCERS).mapInArrow(add, schema).collect()
    shared.destroy()
    seen = sum(r["seen"] for r in changes)
    if seen:
        mean = sum(np.frombuffer(bytes(r["change"]), np.float32).astype(float) * (r["seen"] / seen) for r in changes)
        model.weights = model.weights + mean[:shape].reshape(model.weights.shape).astype(np.float32)
        model.head_weights = model.head_weights + mean[shape:].reshape(model.head_weights.shape).astype(np.float32)


def _change(seen: int, change: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([change.tobytes()], pa.binary())], names=["seen", "change"])


def fit(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model learned from ``docs``; rows (bucket, kind, keys, n, of_word) of all pairs that count and of all words."""
    counts = cut_lineage(_counts(docs))
    model = _statistics(counts)
    model.bits = bucket_bits(model.total)
    pairs = cut_lineage(_pairs(docs, model.head, model.bits))
    _add_pairs(model, pairs)
    shards = max(SHARDS, -(-model.total // (rounds * SHARD_TOKENS)))
    # By id and text, so that copies of one text spread.
    deal = F.xxhash64(*docs.columns)
    for k in range(rounds if model.total else 0):
        share = F.pmod(deal, F.lit(rounds)) == k
        _round(docs.filter(share).repartition(shards, deal), model)
    table = pairs.select("bucket", F.lit(_PAIR).alias("kind"), "keys", "n", "of_word").union(_by_bucket(counts, model.bits))
    return model, table


# What a row of a bucket holds, in the order in which it is read.
_PAIR, _WORD, _ASKED_PAIRS, _ASKED_WORDS, _OWN = range(5)


def _word_buckets(words: np.ndarray, bits: int) -> np.ndarray:
    return pair_keys(np.zeros(len(words), np.int32), words) >> _U(64 - bits)


def _by_bucket(counts: DataFrame, bits: int) -> DataFrame:
    """The counts of words, some rows per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *((k, pa.binary()) for k in ("keys", "n", "of_word"))])
        held, size = [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            words, n = (np.concatenate(x) for x in zip(*held, strict=True))
            buckets = _word_buckets(words, bits)
            order = np.lexsort((words, buckets))
            for bucket, part in _bounds(buckets[order]):
                row = {"bucket": bucket, "kind": _WORD, "keys": _packed_keys(words[order[part]]), "n": _packed(n[order[part]])}
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            held.append((batch.column(0).to_numpy().view(_U), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= _LOOKUPS:
                yield from rows()
                held, size = [], 0
        if size:
            yield from rows()

    return counts.select("word", "n").mapInArrow(run, "bucket int, kind int, keys binary, n binary, of_word binary")


def _score_slice(s: Slice, m: Model, hasher: Hasher) -> tuple:
    """Sums per row over what is at hand, and what is to be looked up, one entry per row and word or pair."""
    t = tokens(s, hasher)
    number = m.head_number(t.keys)
    rows, label = m.contexts(t, number), m.classes(t, number)
    at = np.minimum(np.searchsorted(m.frequent, t.keys), max(len(m.frequent) - 1, 0))
    end = t.keys == END_KEY
    count = np.full(len(t.keys), -1, np.int64)
    if len(m.frequent):
        count = np.where(m.frequent[at] == t.keys, m.frequent_n[at], count)
    count[end] = m.ends
    log_class = np.empty(len(label))
    log_unseen = np.empty(len(label))
    inner = np.zeros(len(label))
    unseen = m.unseen.astype(np.float32)
    for low in range(0, len(label), _STEP):
        part = slice(low, low + _STEP)
        p = _probabilities(m.class_logits(rows, part))
        log_class[part] = p[np.arange(len(p)), label[part]]
        log_unseen[part] = p @ unseen
        head = np.flatnonzero(number[part] >= 0)
        if len(head):
            word = number[part][head]
            q = _probabilities(m.head_log[word // CLASS_WORDS] + m.head_weights[head_rows(rows[2][part][head], word)])
            inner[low + head] = np.log10(q[np.arange(len(word)), word % CLASS_WORDS])
    log_class = np.log10(np.maximum(log_class, 1e-37))
    log_unseen = np.log10(np.maximum(log_unseen, 1e-37))
    # Of the words of the tail: the class's share for words seen, over its mass. The word's count comes later.
    share = np.log10(np.maximum(1 - m.unseen, 1e-12)) - np.log10(m.mass)
    tail = (number < 0) & ~end
    seen = log_class + np.where(tail, share[label], inner)
    known = count > 0
    with_count = tail & known
    seen[with_count] += np.log10(count[with_count] + 0.1)
    # What pairs leave over in the class after this context, and the pair's weight if there is one.
    at = np.flatnonzero(tail)
    before, word_class = rows[3][at], label[at] - HEAD_CLASSES
    left = m.left_log[before, word_class]
    seen[at] += left
    at, pairs = at[left < 0], pair_keys(before[left < 0], t.keys[at[left < 0]])
    place, found = _find(m.pair, pairs)
    seen[at[found]] += m.pair_weight[place[found]]
    scale = np.log10(m.total + 0.1 * (m.distinct + 1))
    base = np.where(count >= 0, np.log10(np.maximum(count, 0) + 0.1) - scale, 0.0)
    lost = end & (count == 0)
    seen[lost] = log_unseen[lost]
    open_ = np.flatnonzero(count < 0)
    row = t.row()
    per_row = (np.diff(t.first), row_sums(known.astype(float), t.first), row_sums(base, t.first), row_sums(seen, t.first))
    words = _merged(row[open_], t.keys[open_], (log_unseen - seen)[open_])
    rest = at[~found]
    return per_row, words, (row[rest], pairs[~found], np.ones(len(rest), np.int32), np.zeros(len(rest)))


def _merged(row: np.ndarray, key: np.ndarray, change: np.ndarray) -> tuple:
    """Rows, keys, their times and the sums of their changes, one entry per row and key."""
    order = np.lexsort((key, row))
    row, key, change = row[order], key[order], change[order]
    new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(key, prepend=_U(0)) != 0))
    times = np.diff(np.append(new, len(row)))
    sums = np.add.reduceat(change, new) if len(new) else np.zeros(0)
    return row[new], key[new], times, sums


_ASKED = [("base", pa.int64()), ("keys", pa.binary()), ("rows", pa.binary()), ("times", pa.binary()), ("change", pa.binary())]


def _asked(kind: int, base: int, held: list, bits: int) -> Iterator[dict]:
    """Lookups (row, key, times, change) of several slices, a record per bucket."""
    row, key, times, change = (np.concatenate(x) for x in zip(*held, strict=True))
    buckets = key >> _U(64 - bits) if kind == _ASKED_PAIRS else _word_buckets(key, bits)
    order = np.argsort(key, kind="stable") if kind == _ASKED_PAIRS else np.lexsort((key, buckets))
    for bucket, part in _bounds(buckets[order]):
        at = order[part]
        record = {"bucket": bucket, "kind": kind, "base": base, "keys": _packed_keys(key[at]), "rows": _packed((row[at] - base).astype(np.int32))}
        record["times"] = _packed(times[at].astype(np.int32))
        if kind == _ASKED_WORDS:
            record["change"] = _packed(change[at])
        yield record


def score(docs: DataFrame, model: Model, table: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score and score.

    ``table`` is what ``fit`` returns of counts and weights. What a task does
    not have at hand is asked of the buckets, many lookups to a record.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))
    rows = docs.select("doc_id", F.col("text").alias("__text"))
    whole = StructType(
        [
            rows.schema.fields[0],
            StructField("n_tokens", LongType()),
            StructField("n_known", LongType()),
            StructField("base", DoubleType()),
            StructField("seen", DoubleType()),
        ]
    )
    bits, scale = model.bits, float(np.log10(model.total + 0.1 * (model.distinct + 1)))
    fields = [StructField("bucket", IntegerType()), StructField("kind", IntegerType()), StructField("base", LongType())]
    fields += [StructField(name, BinaryType()) for name, _ in _ASKED[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, hasher = Model(*shared.value), Hasher()
        next_row = base = TaskContext.get().partitionId() << 36
        held: dict[int, list] = {_ASKED_PAIRS: [], _ASKED_WORDS: []}
        size, struct_type = 0, None

        def asked() -> Iterator[pa.RecordBatch]:
            for kind, own in held.items():
                if own:
                    yield from (_record(x, struct_type) for x in _asked(kind, base, own, bits))
                    own.clear()

        for s in slices(batches, "__text"):
            per_row, words, pairs = _score_slice(s, m, hasher)
            ids = np.arange(next_row, next_row + s.rows.num_rows)
            next_row += s.rows.num_rows
            n, known, base_sum, seen = per_row
            struct = pa.StructArray.from_arrays(
                [s.rows.column(0), pa.array(n), pa.array(known.astype(np.int64)), pa.array(base_sum), pa.array(seen)],
                names=["doc_id", "n_tokens", "n_known", "base", "seen"],
            )
            struct_type = struct.type
            yield _own(ids, mix(ids.astype(_U) + _U(1)) >> _U(64 - bits), struct)
            for kind, (at, *found) in ((_ASKED_PAIRS, pairs), (_ASKED_WORDS, words)):
                if len(at):
                    held[kind].append((ids[at], *found))
                    size += len(at)
            if size >= _LOOKUPS:
                yield from asked()
                base, size = next_row, 0
        if size:
            yield from asked()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, here, known = Model(*shared.value), None, {}
        for batch in batches:
            kinds, buckets = batch.column("kind").to_pylist(), batch.column("bucket").to_pylist()
            for i, (kind, bucket) in enumerate(zip(kinds, buckets, strict=True)):
                if kind == _OWN:
                    continue
                if bucket != here:
                    here, known = bucket, {_PAIR: [], _WORD: []}
                keys = _unpacked_keys(batch.column("keys")[i])
                if kind in (_PAIR, _WORD):
                    n = _unpacked(batch.column("n")[i], np.int64)
                    value = m.pair_weights(keys, n, _unpacked(batch.column("of_word")[i], np.int64)) if kind == _PAIR else n
                    known[kind].append((keys, value))
                    continue
                of = _PAIR if kind == _ASKED_PAIRS else _WORD
                if isinstance(known[of], list):
                    known[of] = _ordered(known[of])
                at, found = _find(known[of][0], keys)
                row, times = _unpacked(batch.column("rows")[i], np.int32), _unpacked(batch.column("times")[i], np.int32)
                sums = np.zeros((3, len(keys)))
                value = known[of][1][at[found]]
                if kind == _ASKED_PAIRS:
                    sums[2, found] = times[found] * value
                else:
                    sums[:, found] = times[found], times[found] * (np.log10(value + 0.1) - scale), times[found] * np.log10(value + 0.1)
                    sums[1, ~found] = times[~found] * (-1.0 - scale)
                    sums[2, ~found] = _unpacked(batch.column("change")[i], np.float64)[~found]
                got = np.unique(row[sums.any(axis=0)])
                totals = [np.bincount(row, x, got[-1] + 1)[got] for x in sums] if len(got) else [np.zeros(0)] * 3
                whole_type = batch.schema.field("whole").type
                base = batch.column("base")[i].as_py()
                yield _sums(got.astype(np.int64) + base, pa.nulls(len(got), whole_type), totals)
            own = batch.filter(pa.array([kind == _OWN for kind in kinds]))
            if own.num_rows:
                yield _sums(own.column("base"), own.column("whole"), [np.zeros(own.num_rows)] * 3)

    added = StructField("whole", whole)
    lookups = rows.mapInArrow(run, StructType([*fields, added]))
    both = table.unionByName(lookups, allowMissingColumns=True)
    met = both.repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "kind")
    sums = [StructField(name, DoubleType()) for name in ("known", "base", "seen")]
    total = met.mapInArrow(answer, StructType([StructField("row", LongType()), added, *sums])).groupBy("row")
    total = total.agg(F.max("whole").alias("whole"), *(F.sum(x.name).alias(x.name) for x in sums))
    return total.select(
        "whole.doc_id",
        F.col("whole.n_tokens").alias("n_tokens"),
        (F.col("whole.n_known") + F.col("known").cast("long")).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("whole.base") + F.col("base")).alias("base_score"),
        (F.col("whole.seen") + F.col("seen")).alias("score"),
    )


def _ordered(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, _U), np.zeros(0)
    keys, values = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def _record(record: dict, whole: pa.DataType) -> pa.RecordBatch:
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *_ASKED, ("whole", whole)])
    return pa.RecordBatch.from_pylist([record], schema)


def _own(ids: np.ndarray, buckets: np.ndarray, whole: pa.StructArray) -> pa.RecordBatch:
    columns = [pa.array(buckets.astype(np.int32)), pa.array(np.full(len(ids), _OWN, np.int32)), pa.array(ids)]
    columns += [pa.nulls(len(ids), t) for _, t in _ASKED[1:]]
    return pa.RecordBatch.from_arrays([*columns, whole], names=["bucket", "kind", *(name for name, _ in _ASKED), "whole"])


def _sums(row, whole, totals) -> pa.RecordBatch:
    row = row if isinstance(row, pa.Array) else pa.array(row)
    return pa.RecordBatch.from_arrays([row, whole, *map(pa.array, totals)], names=["row", "whole", "known", "base", "seen"])


def learnable() -> Column:
    return id_remainder("doc_id", 10) != 0


def lm_scores(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model that held-out documents had no part in."""
    model, table = fit(docs.select("doc_id", "text").filter(learnable()))
    return score(docs, model, table).select(
        "doc_id",
        (id_remainder("doc_id", 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )

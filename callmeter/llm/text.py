"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Texts come as Arrow batches. A batch is cut into slices of a megabyte;
within a slice one pass over the bytes finds all words and one prefix sum of
a polynomial hash gives the hash of each, without a Python object per word.
Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(salt)) | _U(1)


def byte_set(test) -> np.ndarray:
    """A table over the 256 bytes."""
    return np.array([bool(test(b)) for b in range(256)])


def _is_word_byte(b: int) -> bool:
    return b >= 0x80 or chr(b).isalnum()


# Letters and digits; every byte of a character beyond ASCII counts as one.
WORD = byte_set(_is_word_byte)
# Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
# Marks: neither letter, digit nor white space.
MARK = NOT_SPACE & ~WORD

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)


class Hasher:
    """Powers of the hash's base, grown to the longest slice seen. One per task."""

    def __init__(self) -> None:
        self._codes = seeds(256, salt=7)
        self._up = self._down = np.ones(1, dtype=_U)

    def _grow(self, n: int) -> None:
        if len(self._up) <= n:
            size = max(n + 1, SLICE_BYTES + 1)
            up, down = np.full(size, _BASE, dtype=_U), np.full(size, _INVERSE, dtype=_U)
            up[0] = down[0] = 1
            self._up, self._down = np.cumprod(up), np.cumprod(down)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums from which ``span`` reads the hash of any stretch of ``data``."""
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(self._codes[data] * self._up[: len(data)], out=sums[1:])
        return sums

    def span(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(sums))
        return mix((sums[ends] - sums[starts]) * self._down[starts] + (ends - starts).astype(_U))


def bound_batches(spark: SparkSession) -> SparkSession:
    """Have the session hand batches of at most 8 MB and 2,000 rows to Python, which hold several copies of them."""
    for key, most in BATCH_LIMITS.items():
        spark.conf.set(key, most)
    return spark


def release_memory() -> None:
    """Give memory that earlier batches and tasks of this worker have freed back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


@dataclass
class Slice:
    """Some rows of a batch with their text as one array of bytes.

    ``first[i]:first[i + 1]`` are the words of row ``i`` in the arrays
    ``starts``, ``ends`` and ``hashes``.
    """

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray = None
    ends: np.ndarray = None
    hashes: np.ndarray = None
    first: np.ndarray = None

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches, column: str = "text") -> Iterator[Slice]:
    """The rows of the batches in slices of about a megabyte of text, one row at least."""
    for batch in batches:
        release_memory()
        if batch.num_rows == 0:
            continue
        data, offsets = text_bytes(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            at = offsets[low : high + 1]
            yield Slice(batch.slice(low, high - low), data[at[0] : at[-1]], at - at[0])
            low = high


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, and the capitals of Latin-1 in UTF-8."""
    data = _LOWER[data]
    if len(data) > 1:
        after = data[1:]
        capital = (data[:-1] == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
        after[capital] += 0x20
    return data


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes; none crosses a row's end."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    member = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    opens, closes = member.copy(), member.copy()
    opens[1:] &= ~member[:-1] | cut[1:-1]
    closes[:-1] &= ~member[1:] | cut[1:-1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def find_words(s: Slice, hasher: Hasher, inside: np.ndarray = WORD, fold=lower) -> Slice:
    """Fill in the words of a slice."""
    data = fold(s.data) if fold else s.data
    s.starts, s.ends = runs(data, s.offsets, inside)
    s.hashes = hasher.span(hasher.prefix(data), s.starts, s.ends)
    s.first = np.searchsorted(s.starts, s.offsets)
    return s


def n_grams(s: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, row by row, and where each row's begin.

    A row of fewer words has one gram of all its words, or none if it has none.
    """
    counts = np.diff(s.first)
    odd = seeds(n, salt=n)
    full = np.maximum(counts - n + 1, 0)
    short = (counts > 0) & (counts < n)
    out_first = np.concatenate([[0], np.cumsum(full + short)])
    grams = np.zeros(out_first[-1], dtype=_U)
    begin = np.repeat(s.first[:-1] - out_first[:-1], full + short) + np.arange(out_first[-1])
    spare = np.concatenate([s.hashes, np.zeros(n, dtype=_U)])
    for k in range(n):
        grams += spare[begin + k] * odd[k]
    for row in np.flatnonzero(short):
        words = s.hashes[s.first[row] : s.first[row + 1]]
        grams[out_first[row]] = (words * odd[: len(words)]).sum(dtype=_U) + _U(len(words))
    return mix(grams), out_first

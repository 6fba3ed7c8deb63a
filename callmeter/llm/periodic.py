"""Periodic runs of words: Baier's grouping gives Lyndon roots, which common extensions turn into runs.

A run is a stretch of words of smallest period q, of at least two periods and
``least`` words, that no neighbouring word extends. By the runs theorem
(Bannai et al., "The runs theorem", SIAM J. Comput. 2017) each has a Lyndon
root, a longest Lyndon word from its position on under one of two opposite
orders of the words:

1. Phase one of Baier's suffix sorter ("Linear-time suffix sorting", CPM 2016)
   sorts positions into groups by their longest Lyndon prefix; a group's
   length is that prefix's. It is run under both orders. Any order of words
   does; here it is that of their hashes.
2. Each root is extended to both sides by the longest common extension with
   the place one root further, found by bisection over polynomial hashes
   modulo two primes. Roots of one run give the same run, which counts once.

Words outside every repeated 6-gram of their text are in no run (a run of
``least`` >= 12 words repeats each of its 6-grams one period on), so step 1
sees the stretches of repeated 6-grams only. ``least`` must be 12 or more.

Null and empty texts have no words and no runs. A null doc_id has no decimal
form: its text is taken as it is. Rows are independent; repeated rows give
repeated results, an empty table an empty one. Memory grows with the longest
text, of which whole copies are held, by some 100 bytes a word in the
stretches of step 1.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.text import NOT_SPACE, Hasher, find_words, mix, seeds, slices

LEAST = 12
_GRAM = 6
_U = np.uint64
_PRIMES = (2147483629, 2147483587)
_BASES = (1103515245, 1664525001)


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each position. ``ranks`` are 0, 1, ... without gaps."""
    n = len(ranks)
    if n == 0:
        return []
    first_groups = max(ranks) + 1
    members: list[list[int]] = [[] for _ in range(first_groups)]
    for place, rank in enumerate(ranks):
        members[rank].append(place)
    # One entry more, which index -1 reads: no position, in no group, never done.
    group = [*ranks, -2]
    done = bytearray(n + 1)
    # The nearest position to the left in a lower group, then of what is not done.
    lower = [-1] * n
    length = [1] * first_groups
    # Neighbours in the order of groups; the last entry of ``above`` serves as the place above the highest.
    below = list(range(-1, first_groups - 1))
    above = list(range(1, first_groups + 1))
    current, highest = first_groups - 1, True
    while current >= 0:
        own = [place for place in members[current] if group[place] == current]
        members[current] = ()
        children: dict[int, int] = {}
        for place in own:
            left = place - 1
            while done[left]:
                further = lower[left]
                if done[further]:
                    lower[left] = lower[further]
                left = further
            if group[left] == current:
                left = lower[left]
            lower[place] = left
            if left >= 0:
                children[left] = children.get(left, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for place, times in children.items():
            parts.setdefault((times, group[place]), []).append(place)
        for times, old in sorted(parts, reverse=True):
            new = len(length)
            moved = parts[times, old]
            for place in moved:
                group[place] = new
            members.append(moved)
            length.append(length[old] + times * length[current])
            # Right above the group the members come from.
            upper = above[old]
            below.append(old)
            above.append(upper)
            above[old] = new
            below[upper] = new
        for place in own:
            done[place] = 1
        current = below[current]
    return [length[g] for g in group[:n]]


class Extensions:
    """Longest common extensions inside stretches of one array of words."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self._tables = []
        for prime, base in zip(_PRIMES, _BASES, strict=True):
            p = _U(prime)
            power = np.ones(n + 1, dtype=_U)
            have, step = 1, _U(base)
            while have < n + 1:
                upto = min(2 * have, n + 1)
                power[have:upto] = power[: upto - have] * step % p
                have, step = upto, step * step % p
            sums = np.zeros(n + 1, dtype=_U)
            np.cumsum(words % p * power[:n] % p, out=sums[1:])
            self._tables.append((p, power, sums % p))

    def _equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``size`` words from ``a`` and ``b`` (a < b) are equal."""
        out = np.ones(len(a), dtype=bool)
        for p, power, sums in self._tables:
            left = (sums[a + size] + p - sums[a]) % p * power[b - a] % p
            out &= left == (sums[b + size] + p - sums[b]) % p
        return out

    def _bisect(self, most: np.ndarray, equal) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.astype(np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) // 2
            same = equal(open_, middle)
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1
        return low

    def right(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` on are equal, up to ``most``."""
        return self._bisect(most, lambda at, size: self._equal(a[at], b[at], size))

    def left(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` are equal, up to ``most``."""
        return self._bisect(most, lambda at, size: self._equal(a[at] - size, b[at] - size, size))


def _repeated_stretches(words: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of a text all of whose words are in 6-grams that the text repeats."""
    n = len(words)
    if n < 2 * _GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    odd = seeds(_GRAM + 1, salt=31)
    grams = text_of[: n - _GRAM + 1].astype(_U) * odd[_GRAM]
    for k in range(_GRAM):
        grams += words[k : n - _GRAM + 1 + k] * odd[k]
    at = np.flatnonzero(text_of[: n - _GRAM + 1] == text_of[_GRAM - 1 :])
    keys = mix(grams[at])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(at), bool)
    again[1:] |= same
    again[:-1] |= same
    at = at[order[again]]
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + _GRAM, -1)
    inside = np.cumsum(cover[:-1]) > 0
    opens, closes = inside.copy(), inside.copy()
    cut = text_of[1:] != text_of[:-1]
    opens[1:] &= ~inside[:-1] | cut
    closes[:-1] &= ~inside[1:] | cut
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (text, start, end, period) of all runs, by text, start and period; ``first`` says where texts begin."""
    if least < 2 * _GRAM:
        raise ValueError(f"runs of fewer than {2 * _GRAM} words may repeat no {_GRAM}-gram")
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin, end = _repeated_stretches(words, text_of)
    long = end - begin >= least
    begin, end = begin[long], end[long]
    if len(begin) == 0:
        return np.zeros((0, 4), np.int64)
    # The stretches one after the other, a separator below all words after each.
    size = end - begin
    offset = np.concatenate([[0], np.cumsum(size + 1)])
    total = int(offset[-1])
    stretch = np.repeat(np.arange(len(begin)), size + 1)
    own = np.ones(total, bool)
    own[offset[1:] - 1] = False
    source = np.arange(total) - offset[stretch] + begin[stretch]
    _, rank = np.unique(words[source[own]], return_inverse=True)
    high = int(rank.max())
    codes = np.zeros(total, dtype=_U)
    codes[own] = words[source[own]]
    extensions = Extensions(codes)
    found = []
    for ranks in (rank + 1, high - rank + 1):
        ordered = np.zeros(total, np.int64)
        ordered[own] = ranks
        period = np.array(lyndon_lengths(ordered.tolist()), dtype=np.int64)
        a = np.flatnonzero(own)
        b = a + period[a]
        low, top = offset[stretch[a]], offset[stretch[a] + 1] - 1
        # The stretch has to hold two periods, and the next word to the right or left has to fit.
        fits = (b <= top) & (top - low >= 2 * period[a])
        fits &= (codes[a] == codes[np.minimum(b, total - 1)]) | ((a > low) & (codes[a - 1] == codes[b - 1]))
        a, b, low, top = a[fits], b[fits], low[fits], top[fits]
        right = extensions.right(a, b, top - b)
        left = extensions.left(a, b, a - low)
        q = b - a
        good = (left + right >= q) & (left + right + q >= least)
        found.append(np.stack([stretch[a[good]], a[good] - left[good], b[good] + right[good], q[good]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)
    at = source[np.minimum(runs[:, 1], total - 1)]
    text = text_of[at] if len(at) else at
    start = at - first[text]
    rows = np.stack([text, start, start + runs[:, 2] - runs[:, 1], runs[:, 3]], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def repeat_tail(doc_id: int | None, words: int) -> np.ndarray | None:
    """Which word each place of a text holds where its tail is made periodic, by a rule on the id; None where it is not."""
    if doc_id is None or words == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % words
    p = 1 + (words - a) // (3 + g % 8)
    places = np.arange(words)
    places[a:] = a + (places[a:] - a) % p
    return places


_SCHEMA = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _digests(words: list[bytes], runs: np.ndarray) -> tuple:
    """The columns of ``_SCHEMA`` for one text."""
    lines = "".join(f"{start},{end - start},{period}\n" for start, end, period in runs.tolist())
    best = (None, None, None, None)
    if len(runs):
        size = runs[:, 1] - runs[:, 0]
        k = int(np.lexsort((runs[:, 2], runs[:, 0], -size))[0])
        length, period = int(size[k]), int(runs[k, 2])
        best = (int(runs[k, 0]), length, period, 1000 * length // period)
        dropped = np.zeros(len(words) + 1, np.int64)
        np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
        np.add.at(dropped, runs[:, 1], -1)
        words = compress(words, (np.cumsum(dropped[:-1]) == 0).tolist())
    collapsed = hashlib.sha256(b" ".join(words)).hexdigest()
    return (len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), collapsed)


def periodic_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least: int = LEAST, places=None) -> DataFrame:
    """Per row: its id, the number of its runs, its longest run, and digests of all runs and of the text without repeats.

    Of equally long runs the one that starts first counts, then that of the
    smaller period. ``places(id, words)`` may name the word that each place
    holds in place of its own.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, {_SCHEMA}"
    names = ["doc_id", *(part.split()[0] for part in _SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for s in slices(batches, "__text"):
            find_words(s, hasher, NOT_SPACE, None)
            ids = s.rows.column(0).to_pylist()
            hashes, mapped = s.hashes, {}
            if places is not None:
                hashes = hashes.copy()
                for i, doc_id in enumerate(ids):
                    low, high = s.first[i], s.first[i + 1]
                    held = places(doc_id, int(high - low))
                    if held is not None:
                        mapped[i] = held
                        hashes[low:high] = s.hashes[low:high][held]
            found = find_runs(hashes, s.first, least)
            at = np.searchsorted(found[:, 0], np.arange(len(ids) + 1))
            raw = s.data.tobytes()
            out = []
            for i in range(len(ids)):
                words = raw[s.offsets[i] : s.offsets[i + 1]].split()
                if i in mapped:
                    words = [words[k] for k in mapped[i].tolist()]
                out.append(_digests(words, found[at[i] : at[i + 1], 1:]))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names
            )

    return rows.mapInArrow(run, schema)


def repeats(docs: DataFrame) -> DataFrame:
    """The runs of all documents, of which a tenth, by their id, have a periodic tail."""
    return periodic_runs(docs, places=repeat_tail)

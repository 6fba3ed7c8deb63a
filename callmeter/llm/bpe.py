"""Ids of many texts by a byte-level BPE vocabulary, each distinct piece encoded once.

Such tokenizers split a text into pieces by a fixed pattern and encode each
independently of the others. Pieces are found here for all texts of a slice
at once, from the classes of their characters; distinct ones are encoded by
the library and remembered, up to a bounded number. Strings of special tokens
have the ids of these; the text on either side of one is encoded by itself.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import tiktoken

from callmeter.llm.text import Hasher, Slice

LETTER, NUMBER, SPACE, MARK = range(4)
END = 0
# Distinct pieces remembered at a time.
_REMEMBERED = 1 << 20
# The characters that \s stands for, and the endings that the pattern splits off.
_WHITE = {9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def character_class(point: int) -> int:
    if point in _WHITE:
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(point))[0], MARK)


class Pieces:
    """Finds the pieces of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``."""

    def __init__(self) -> None:
        self._classes = np.array([character_class(c) for c in range(1 << 16)], dtype=np.uint8)

    def classes(self, points: np.ndarray) -> np.ndarray:
        out = self._classes[np.minimum(points, (1 << 16) - 1)]
        for at in np.flatnonzero(points >= 1 << 16):
            out[at] = character_class(int(points[at]))
        return out

    def find(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of a slice start, in bytes, and the first piece of each row."""
        data = s.data
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        n = len(points)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(len(s.offsets), np.int64)
        first = np.searchsorted(at, s.offsets)
        kind = self.classes(points)
        row_start = np.zeros(n + 1, bool)
        row_start[first] = True
        run = row_start[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = run.copy()
        # A run that is not white space takes the blank before it along.
        inner = ~row_start[1:n]
        joined = run[1:] & inner & (points[:-1] == 0x20) & (kind[1:] != SPACE)
        start[1:][joined] = False
        # The last white space before something else is a piece of its own, or that blank.
        last = run[1:] & inner & (kind[:-1] == SPACE)
        start[:-1] |= last
        self._split_endings(points, kind, run, start, row_start)
        begins = np.flatnonzero(start)
        return at[begins], np.searchsorted(begins, first)

    @staticmethod
    def _split_endings(points, kind, run, start, row_start) -> None:
        n = len(points)
        quotes = np.flatnonzero((points == 0x27) & start & run)
        for q in quotes.tolist():
            for ending in _ENDINGS:
                end = q + 1 + len(ending)
                if end <= n and all(points[q + 1 + k] == ord(c) and not row_start[q + 1 + k] for k, c in enumerate(ending)):
                    start[q + 1] = False
                    if end < n and not row_start[end] and kind[end] == LETTER:
                        start[end] = True
                    break


class PieceTable:
    """Encodes slices. One per task."""

    def __init__(self, path: str, pattern: str, special: dict[str, int] | None = None):
        ranks = load_ranks(path)
        self._special = {text.encode(): number for text, number in (special or {}).items()}
        # Of several that begin at one place the longest counts.
        listed = sorted(self._special, key=len, reverse=True)
        self._special_pattern = re.compile(b"|".join(map(re.escape, listed))) if listed else None
        self._encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._pieces, self._hasher = Pieces(), Hasher()
        self._forget()

    def _forget(self) -> None:
        self._number: dict[int, int] = {}
        self._ids = np.zeros(1 << 16, dtype=np.uint32)
        self._begin = np.zeros(1, dtype=np.int64)

    def _learn(self, keys: list[int], texts: list[bytes]) -> None:
        ids = [self._encode(t.decode("utf-8")) for t in texts]
        used = int(self._begin[-1])
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        total = used + int(sizes.sum())
        if total > len(self._ids):
            self._ids = np.concatenate([self._ids[:used], np.zeros(max(total, 2 * used), dtype=np.uint32)])
        self._ids[used:total] = [i for x in ids for i in x]
        known = len(self._begin) - 1
        self._begin = np.concatenate([self._begin, used + np.cumsum(sizes)])
        self._number.update(zip(keys, range(known, known + len(keys)), strict=True))

    def encode(self, s: Slice) -> Iterator[np.ndarray]:
        """For each row of the slice its ids and ``END``, as 32-bit numbers."""
        starts, first = self._pieces.find(s)
        ends = np.append(starts[1:], len(s.data))
        hashes = self._hasher.span(self._hasher.prefix(s.data), starts, ends)
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._number) > _REMEMBERED:
            self._forget()
        listed = keys.tolist()
        new = [k for k, key in enumerate(listed) if key not in self._number]
        raw = s.data.tobytes()
        self._learn([listed[k] for k in new], [raw[starts[at[k]] : ends[at[k]]] for k in new])
        number = np.array([self._number[key] for key in listed], dtype=np.int64)[which]
        begin, size = self._begin[number], self._begin[number + 1] - self._begin[number]
        out_end = np.cumsum(size)
        take = np.repeat(begin - (out_end - size), size) + np.arange(out_end[-1] if len(out_end) else 0)
        ids = self._ids[take]
        cuts = np.concatenate([[0], out_end])[first]
        parted = self._with_special(raw, s.offsets)
        for row, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            yield np.append(parted[row] if row in parted else ids[low:high], np.uint32(END))

    def _with_special(self, raw: bytes, offsets: np.ndarray) -> dict[int, np.ndarray]:
        """The ids of the rows that hold strings of special tokens."""
        if self._special_pattern is None or self._special_pattern.search(raw) is None:
            return {}
        out = {}
        for row, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            ids, at = [], low
            for m in self._special_pattern.finditer(raw, low, high):
                ids += [*self._encode(raw[at : m.start()].decode("utf-8")), self._special[m[0]]]
                at = m.end()
            if at > low:
                out[row] = np.array([*ids, *self._encode(raw[at:high].decode("utf-8"))], dtype=np.uint32)
        return out

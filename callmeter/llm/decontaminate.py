"""Benchmark decontamination: rare word pairs find passages, Smith-Waterman alignment scores them.

Words are runs of letters and digits, folded to lower case (A to Z and
Latin-1). A document is aligned with an item word by word: +1 for a match, -1
for a mismatch or gap. The score is the best local alignment divided by the
words of the item; 0.5 or more is a match.

Seeds are word pairs. An alignment of score s with e edits has s + e matches in
at most e + 1 runs, so at least s - 1 pairs of adjacent words of the item are
in the document as they are. Pairs that the corpus lacks cannot be among them.
Of the others the most frequent are left out, no more than keep ``need`` of
those s - 1 hits certain. Insertions and deletions move an alignment over at
most (words of the item - s) diagonals; where ``need`` hits lie that close, the
stretch of the document around them is aligned. So no match is missed.

Items are compared as a whole, whatever their length; an alignment costs the
product of the item's words and the stretch's. ``min_words`` sets from how many
words on an item is compared. From three words on a match holds a pair of
adjacent words; of fewer, one word would be half the item, so such items match
nothing by definition, as do null ones, and null and empty documents. Items of
equal words are compared once, and all their ids named; documents are compared
as often as they occur. A repeated id of an item gets the best score of its
rows. Empty tables give an empty result, and leave all documents.

Items are broadcast in blocks of a running number of words, ``BLOCK_WORDS`` and
at most one item more, one scan of the documents for each block; a fixed-size
bitmap of word pairs serves the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from callmeter.llm.blocks import running_blocks
from callmeter.llm.text import Hasher, Slice, find_words, n_grams, slices
from callmeter.operators.durable import cut_lineage

GRAM = 2
MIN_WORDS = 3
LEAST = 0.5
# Words of test items in one broadcast.
BLOCK_WORDS = 1 << 20
_BITS = 24
_CELLS = 1 << 21


def _item_words(items: DataFrame, min_words: int) -> DataFrame:
    """Rows (item_id, words): an item's words as hashes, in 8 bytes each; items of too few words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for s in slices(batches, "__text"):
            find_words(s, hasher)
            rows = np.flatnonzero(np.diff(s.first) >= min_words)
            words = [s.hashes[s.first[i] : s.first[i + 1]].tobytes() for i in rows]
            yield pa.RecordBatch.from_arrays([s.rows.column(0).take(pa.array(rows)), pa.array(words, pa.binary())], names=["item_id", "words"])

    rows = items.select("item_id", F.col("text").alias("__text"))
    return rows.mapInArrow(run, StructType([rows.schema.fields[0]]).add("words", "binary"))


def _pairs(words: np.ndarray) -> np.ndarray:
    whole = Slice(None, None, None, hashes=words, first=np.array([0, len(words)]))
    return n_grams(whole, GRAM)[0]


def _item_grams(distinct: DataFrame) -> DataFrame:
    """The distinct word pairs of each item, and how often each is in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                words = np.frombuffer(one.column(0)[0].as_py(), dtype=np.uint64)
                grams, times = np.unique(_pairs(words), return_counts=True)
                repeat = pa.array(np.zeros(len(grams), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [one.column(0).take(repeat), pa.array(grams.view(np.int64)), pa.array(times.astype(np.int64))],
                    names=["words", "gram", "times"],
                )

    return distinct.mapInArrow(run, "words binary, gram long, times long")


def _bitmap(grams: DataFrame) -> np.ndarray:
    """2**24 bits, set at the low bits of each gram."""
    place = F.col("gram").bitwiseAND(F.lit((1 << _BITS) - 1)) + 1
    parts = grams.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(1 << (_BITS - 3), dtype=np.uint8)
    for row in parts.collect():
        out[(row["part"] - 1) * 4096 :][:4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def _marked(bitmap: np.ndarray, grams: np.ndarray) -> np.ndarray:
    low = grams & np.uint64((1 << _BITS) - 1)
    return (bitmap[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _corpus_counts(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Counts over the documents of the word pairs that the bitmap lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for s in slices(batches):
            grams, _ = n_grams(find_words(s, hasher), GRAM)
            found, counts = np.unique(grams[_marked(shared.value, grams)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _seeds(distinct: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Rows (words, grams, need): the items that the corpus may hold, with their seeds.

    Every alignment that reaches ``least`` hits at least ``need`` of the places of the seeds.
    """
    grams = _item_grams(distinct)
    counted = grams.join(_corpus_counts(docs, _bitmap(grams)), "gram")
    # Pairs that an alignment has for certain, and how many of them are to be hits of seeds.
    sure = F.ceil(F.lit(least) * (F.length("words") / 8)) - 1
    counted = counted.withColumn("sure", sure).withColumn("few", F.greatest(F.least(F.lit(2), "sure"), F.floor(F.col("sure") / 4)))
    own = Window.partitionBy("words")
    common = own.orderBy(F.desc("n"), F.desc("gram")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumns({"left_out": F.sum("times").over(common), "all": F.sum("times").over(own)})
    chosen = counted.filter((F.col("all") >= F.col("sure")) & (F.col("left_out") > F.col("sure") - F.col("few")))
    need = F.first("sure") - (F.first("all") - F.sum("times"))
    return chosen.groupBy("words").agg(F.collect_set("gram").alias("grams"), need.cast("long").alias("need"))


class _Items:
    """Items and their seeds, indexed for the scan."""

    def __init__(self, words: list[bytes], grams: list[list[int]], need: list[int], least: float):
        self.least = least
        self.words = [np.frombuffer(w, dtype=np.uint64) for w in words]
        seed, item, place = [], [], []
        self.need = np.array(need, dtype=np.int64)
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        # Diagonals over which an alignment can stretch.
        self.slack = self.size - np.ceil(least * self.size).astype(np.int64)
        for i, (own, chosen) in enumerate(zip(self.words, grams, strict=True)):
            all_grams = _pairs(own)
            at = np.flatnonzero(np.isin(all_grams, np.array(chosen, dtype=np.int64).view(np.uint64)))
            seed.append(all_grams[at])
            item.append(np.full(len(at), i))
            place.append(at)
        seed, item, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seed, item, place))
        seed = seed.astype(np.uint64)
        order = np.argsort(seed, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.seeds, self.at = np.unique(seed[order], return_index=True)
        self.at = np.append(self.at, len(order))
        self.bitmap = np.zeros(1 << (_BITS - 3), dtype=np.uint8)
        low = self.seeds & np.uint64((1 << _BITS) - 1)
        np.bitwise_or.at(self.bitmap, (low >> np.uint64(3)).astype(np.int64), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))

    def candidates(self, s: Slice) -> np.ndarray:
        """Rows (row, item, low, high): the stretch of words of a row that may hold an item."""
        grams, first = n_grams(s, GRAM)
        at = np.flatnonzero(_marked(self.bitmap, grams))
        if len(at) == 0 or len(self.seeds) == 0:
            return np.zeros((0, 4), np.int64)
        found = np.minimum(np.searchsorted(self.seeds, grams[at]), len(self.seeds) - 1)
        real = self.seeds[found] == grams[at]
        at, found = at[real], found[real]
        times = self.at[found + 1] - self.at[found]
        row = np.searchsorted(first, at, "right") - 1
        # Whole rows of the slice at a time, of a bounded number of hits but for the last row.
        before = np.cumsum(times) - times
        part = before[np.searchsorted(row, row)] // _CELLS
        cuts = np.flatnonzero(np.diff(part)) + 1
        counts = np.diff(s.first)
        out = [np.zeros((0, 4), np.int64)]
        for now in np.split(np.arange(len(at)), cuts):
            out.append(self._stretches(row[now], at[now] - first[row[now]], found[now], times[now], counts))
        return np.concatenate(out)

    def _stretches(self, row: np.ndarray, place: np.ndarray, found: np.ndarray, times: np.ndarray, counts: np.ndarray) -> np.ndarray:
        offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.at[found], times) + offset
        row, item = np.repeat(row, times), self.item[entry]
        diagonal = np.repeat(place, times) - self.place[entry]
        order = np.lexsort((diagonal, item, row))
        row, item, diagonal = row[order], item[order], diagonal[order]
        # Hits with enough others close by.
        begin = np.arange(len(row))
        end = begin + self.need[item] - 1
        last = np.minimum(end, len(row) - 1)
        close = (end < len(row)) & (row[last] == row) & (item[last] == item) & (diagonal[last] - diagonal <= self.slack[item])
        inside = np.zeros(len(row) + 1, np.int64)
        np.add.at(inside, begin[close], 1)
        np.add.at(inside, end[close] + 1, -1)
        held = np.cumsum(inside[:-1]) > 0
        row, item, diagonal = row[held], item[held], diagonal[held]
        slack = self.slack[item]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])
        begin = np.flatnonzero(new)
        end = np.append(begin, len(row))[1:] - 1
        low = np.maximum(0, diagonal[begin] - slack[begin])
        high = np.minimum(counts[row[begin]], diagonal[end] + self.size[item[begin]] + slack[begin])
        return np.stack([row[begin], item[begin], low, high], axis=1)

    def matches(self, s: Slice) -> np.ndarray:
        """Rows (row, item, score in words, start, end) of the alignments that reach ``least``."""
        found = self.candidates(s)
        size = self.size[found[:, 1]]
        width = found[:, 3] - found[:, 2]
        out = []
        order = np.lexsort((width, size))
        while len(order):
            room = max(1, int(_CELLS // max(1, width[order].max())))
            now, order = order[:room], order[room:]
            m, n = int(size[now].max()), int(width[now].max())
            items = np.zeros((len(now), m), dtype=np.uint64)
            texts = np.ones((len(now), n), dtype=np.uint64)
            for k, c in enumerate(now):
                row, item, low, high = found[c]
                items[k, : size[c]] = self.words[item]
                begin = s.first[row]
                texts[k, : high - low] = s.hashes[begin + low : begin + high]
            score, start, end = align(items, texts)
            good = score >= self.least * size[now]
            hit = found[now[good]]
            out.append(np.stack([hit[:, 0], hit[:, 1], score[good], hit[:, 2] + start[good], hit[:, 2] + end[good]], axis=1))
        return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


def align(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair of rows: score, and where it starts and ends in the text.

    Both are padded, with 0 and 1. A cell holds the score and, below it, the
    start of its alignment (earlier is greater), so that one maximum does both.
    """
    k, n = texts.shape
    unit = np.int64(1) << 32
    column = np.arange(n + 1, dtype=np.int64)
    fresh = unit - 1 - column
    best = np.tile(fresh[0], k)
    best_end = np.zeros(k, dtype=np.int64)
    above = np.tile(fresh, (k, 1))
    for i in range(items.shape[1]):
        step = np.where(texts == items[:, i : i + 1], unit, -unit)
        here = np.maximum(fresh, above - unit)
        here[:, 1:] = np.maximum(here[:, 1:], above[:, :-1] + step)
        # Gaps in the item: the best cell to the left, less one for each column between.
        here = np.maximum.accumulate(here + column * unit, axis=1) - column * unit
        here = np.maximum(here, fresh)
        end = here.argmax(axis=1)
        top = here[np.arange(k), end]
        better = top > best
        best[better], best_end[better] = top[better], end[better]
        above = here
    score = best // unit
    return score, unit - 1 - best % unit, best_end


def _blocks(words: DataFrame, docs: DataFrame, least: float, min_words: int) -> Iterator[list]:
    """Rows (row, words, grams, need) of distinct items with their seeds, in lists of a bounded number of words."""
    if least * min_words <= 1:
        raise ValueError(f"least must be above {1 / min_words}: an alignment of one word has no seed")
    # Each sequence of words once, however many items hold it.
    distinct = cut_lineage(words.select("words").distinct())
    seeded = cut_lineage(_seeds(distinct, docs, least).withColumn("row", F.monotonically_increasing_id()))
    placed = running_blocks(seeded.withColumn("size", F.length("words") / 8), "size", BLOCK_WORDS)
    for number in sorted(r["block"] for r in placed.select("block").distinct().collect()):
        yield placed.filter(F.col("block") == number).select("row", "words", "grams", "need").collect()


def _columns(block: list) -> tuple[list, list, list]:
    return [bytes(r["words"]) for r in block], [list(r["grams"]) for r in block], [r["need"] for r in block]


_FOUND = "row long, words binary, score double, start_word long, end_word long"


def contamination(docs: DataFrame, items: DataFrame, least: float = LEAST, min_words: int = MIN_WORDS) -> DataFrame:
    """Matching pairs: doc_id, item_id, score, and the words of the document (from, to) that are aligned.

    One row per document row and item id, that of the best score, then of the
    earliest start.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", F.col("text").alias("__text"), F.monotonically_increasing_id().alias("__row"))
    schema = StructType([rows.schema.fields[0], *_schema(_FOUND)])
    words = cut_lineage(_item_words(items, min_words))
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(words, docs, least, min_words):
        shared = context.broadcast(_columns(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            texts = shared.value[0]
            held, hasher = _Items(*shared.value, least), Hasher()
            for s in slices(batches, "__text"):
                hits = held.matches(find_words(s, hasher))
                best: dict[tuple, tuple] = {}
                for row, item, score, start, end in hits.tolist():
                    value = (score / int(held.size[item]), -start, end)
                    if best.get((row, item), (0,)) < value:
                        best[row, item] = value
                rows = pa.array([row for row, _ in best], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        s.rows.column(0).take(rows),
                        s.rows.column(2).take(rows),
                        pa.array([texts[item] for _, item in best], pa.binary()),
                        pa.array([v[0] for v in best.values()], pa.float64()),
                        pa.array([-v[1] for v in best.values()], pa.int64()),
                        pa.array([v[2] for v in best.values()], pa.int64()),
                    ],
                    names=schema.names,
                )

        found = found.unionByName(rows.mapInArrow(run, schema))
    named = found.join(words.select("item_id", "words").distinct(), "words")
    value = F.struct("score", (-F.col("start_word")).alias("start"), "end_word")
    best = named.groupBy("row", "doc_id", "item_id").agg(F.max(value).alias("best"))
    return best.select(
        "doc_id", "item_id", "best.score", (-F.col("best.start")).alias("start_word"), F.col("best.end_word").alias("end_word")
    )


def _schema(fields: str) -> list[StructField]:
    return StructType.fromDDL(fields).fields


def drop_contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, that match no item."""
    context = docs.sparkSession.sparkContext
    words = _item_words(items, min_words)
    for block in _blocks(words, docs, least, min_words):
        shared = context.broadcast(_columns(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held, hasher = _Items(*shared.value, least), Hasher()
            for s in slices(batches, "text"):
                hits = held.matches(find_words(s, hasher))
                clean = np.ones(s.rows.num_rows, bool)
                clean[hits[:, 0]] = False
                yield s.rows.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

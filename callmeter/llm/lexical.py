"""Ranked lexical search: the best documents of each item, exactly, by a dual-tree search.

After Ram and Gray, "Maximum inner-product search using cone trees" (KDD
2012) and Curtin and Ram, "Dual-tree fast exact max-kernel search" (2014),
with coordinate maxima as bounds: a score is an inner product of an item's
term weights and a document's term impacts, none of which is negative.

1. One scan of the texts turns each document into its number of terms and its
   counts of the items' terms; that is stored. The corpus statistics (N, L,
   document frequencies) are sums over the stored rows.
2. Items of a block form a hierarchy, documents another one per batch. A node
   holds, term by term, the greatest value below it. The inner product of two
   nodes' maxima bounds all scores of the pair; a pair whose bound is below the
   weakest tenth-best score of its items is left out with all it holds.
   Children of a pair are taken together until single items meet leaves of
   documents, whose scores are worked out as whole numbers.
3. Each task keeps the best of what it has seen. A first pass over a share of
   the documents gives every item a floor to begin with, so that later tasks
   hand on few rows; the floors are scores of real documents, so no result is
   lost. A window ranks what the tasks found.

A term is a run of letters, digits and characters beyond ASCII, A to Z in
lower case, known by a 64-bit hash. Null and empty texts have no terms; such
items have no results and such documents count in no statistic. Every row is an
item or a document of its own, repeated ids too. Equal scores rank by the
smaller id, null ids last. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from callmeter.llm.blocks import running_blocks
from callmeter.llm.linear import hash_share
from callmeter.llm.text import WORD, Hasher, find_words, lower_ascii, slices
from callmeter.operators.durable import cut_lineage

TOP = 10
# Terms of items in one broadcast: a scan of the documents for each block.
BLOCK_TERMS = 1 << 16
# Documents that give the first floors, about so many.
FIRST = 32_768
LEAF = 64
FAN_OUT = 8
# Sums below this are exact in floating point.
_EXACT = 2.0**53
# For bounds, which are rounded where scores are not exact in floating point.
_SLACK = 1 + 1e-9


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (row, item_id, terms, size): each item's terms in order, as hashes in 8 bytes each; stored."""
    rows = items.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("item_id"), F.col(text_col).alias("__text")
    )
    schema = StructType([*rows.schema.fields[:2]]).add("terms", "binary").add("size", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for s in slices(batches, "__text"):
            find_words(s, hasher, WORD, lower_ascii)
            own = [s.hashes[a:b].tobytes() for a, b in zip(s.first[:-1], s.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*s.rows.columns[:2], pa.array(own, pa.binary()), pa.array(np.diff(s.first))], names=schema.names
            )

    return cut_lineage(rows.mapInArrow(run, schema))


def _project(docs: DataFrame, vocabulary: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, n, terms, times): a document's number of terms, and those of the sorted vocabulary with their counts; stored."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    schema = StructType([rows.schema.fields[0]]).add("n", "long").add("terms", "binary").add("times", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(), shared.value
        for s in slices(batches, "__text"):
            find_words(s, hasher, WORD, lower_ascii)
            at = np.minimum(np.searchsorted(known, s.hashes), len(known) - 1)
            held = known[at] == s.hashes
            pair = s.row_of_word()[held] * len(known) + at[held]
            pair, times = np.unique(pair, return_counts=True)
            row, term = pair // len(known), (pair % len(known)).astype(np.int32)
            cut = np.searchsorted(row, np.arange(len(s.first)))
            times = times.astype(np.int32)
            parts = [[x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)] for x in (term, times)]
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0), pa.array(np.diff(s.first)), *(pa.array(p, pa.binary()) for p in parts)], names=schema.names
            )

    return cut_lineage(rows.mapInArrow(run, schema))


def _joined(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of byte strings, and how many each row holds."""
    parts = [v.as_buffer() for v in column]
    values = [np.frombuffer(p, dtype) for p in parts]
    return (np.concatenate(values) if values else np.zeros(0, dtype)), np.array([len(v) for v in values], dtype=np.int64)


def _document_counts(projected: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_joined(batch.column(0), np.int32)[0], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    found = projected.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    out = np.zeros(size, np.int64)
    out[found["term"].to_numpy(np.int64)] = found["df"].to_numpy(np.int64)
    return out


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def impacts(times: np.ndarray, lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A term's part in the score of a document of ``lengths`` terms that holds it ``times`` times, before its weight."""
    if len(lengths) and 75 * int(lengths.max()) * documents >= 1 << 63:
        m = np.array([25 + 75 * n * documents // terms for n in lengths.tolist()], dtype=np.int64)
    else:
        m = 25 + 75 * lengths * documents // max(terms, 1)
    return 1_000_000_000 * times // (1000 * times + 8 * m)


def _rows_of(first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the chosen rows of a compressed table, and where each row's begin among them."""
    size = first[chosen + 1] - first[chosen]
    at = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(first[chosen] - at[:-1], size) + np.arange(at[-1]), at


class Level:
    """Nodes of one level of a hierarchy: for each its terms in order, and the greatest value of each below it."""

    def __init__(self, node: np.ndarray, term: np.ndarray, value: np.ndarray, nodes: int):
        order = np.lexsort((term, node))
        node, term, value = node[order], term[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (term[1:] != term[:-1])])) if len(node) else []
        self.term = term[new] if len(node) else term
        self.value = np.maximum.reduceat(value, new) if len(node) else value
        self.first = np.searchsorted(node[new] if len(node) else node, np.arange(nodes + 1))

    def above(self) -> Level:
        nodes = len(self.first) - 1
        node = np.repeat(np.arange(nodes), np.diff(self.first)) // FAN_OUT
        return Level(node, self.term, self.value, -(-nodes // FAN_OUT))

    def bounds(self, chosen: np.ndarray, maxima: np.ndarray) -> np.ndarray:
        """The inner products of the chosen nodes' maxima with those of another node, given for every term."""
        entries, at = _rows_of(self.first, chosen)
        sums = np.concatenate([[0.0], np.cumsum(self.value[entries] * maxima[self.term[entries]])])
        return sums[at[1:]] - sums[at[:-1]]


def _hierarchy(lowest: Level) -> list[Level]:
    """The levels from the lowest up to a single root."""
    levels = [lowest]
    while len(levels[-1].first) > 2:
        levels.append(levels[-1].above())
    return levels


class ItemTree:
    """A block's items: their hierarchy over term weights, alike items next to each other."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        """``terms`` are the items' terms as places in ``weights``, repeats included."""
        item = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        term = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        pair, times = np.unique(item * max(len(weights), 1) + term, return_counts=True)
        item, term = pair // max(len(weights), 1), pair % max(len(weights), 1)
        value = (weights[term] * times).astype(float)
        # Neighbours share their most frequent term, then their rarest.
        common, rare = np.full(len(terms), len(weights)), np.full(len(terms), -1)
        by_weight = np.argsort(weights, kind="stable")
        place = np.empty(len(weights), np.int64)
        place[by_weight] = np.arange(len(weights))
        np.minimum.at(common, item, place[term])
        np.maximum.at(rare, item, place[term])
        self.order = np.lexsort((rare, common))
        number = np.empty(len(terms), np.int64)
        number[self.order] = np.arange(len(terms))
        self.levels = _hierarchy(Level(number[item], term, value, len(terms)))
        self.terms = len(weights)
        self.most = float(np.bincount(item, weights=value).max(initial=0)) * 1_000_000


class Search:
    """The best documents so far of the items of a tree."""

    def __init__(self, tree: ItemTree, weights: np.ndarray, floors: np.ndarray, top: int):
        self.tree, self.weights, self.top = tree, weights, top
        # Floors by place in the tree: of all levels, the least below each node. A score has to be above 0.
        self.floor = [np.maximum(floors[tree.order], 1).astype(float)]
        for _ in tree.levels[1:]:
            self.floor.append(np.minimum.reduceat(self.floor[-1], np.arange(0, len(self.floor[-1]), FAN_OUT)))
        self.best: list[list[tuple]] = [[] for _ in tree.order]
        self.maxima = np.zeros(tree.terms)
        self.place = np.zeros(tree.terms, np.int64)
        self.scored = 0

    def _raise(self, item: int) -> None:
        kept = self.best[item]
        if len(kept) < self.top:
            return
        self.floor[0][item] = max(self.floor[0][item], -kept[-1][0])
        for low, high in zip(self.floor[:-1], self.floor[1:], strict=True):
            item //= FAN_OUT
            high[item] = low[item * FAN_OUT : (item + 1) * FAN_OUT].min()

    def add(self, ids: list, lengths: np.ndarray, term: np.ndarray, size: np.ndarray, impact: np.ndarray) -> None:
        """Search a batch of documents, given by the terms they hold."""
        docs = np.flatnonzero(size)
        if len(docs) == 0:
            return
        # Neighbours share their rarest term.
        doc = np.repeat(np.arange(len(size)), size)
        heavy = np.zeros(len(size), np.int64)
        np.maximum.at(heavy, doc, self.weights[term] * self.tree.terms + term)
        order = docs[np.argsort(-heavy[docs], kind="stable")]
        number = np.empty(len(size), np.int64)
        number[order] = np.arange(len(order))
        lowest = Level(number[doc], term, impact.astype(float), len(order))
        leaves = Level(np.repeat(np.arange(len(order)), np.diff(lowest.first)) // LEAF, lowest.term, lowest.value, -(-len(order) // LEAF))
        levels = _hierarchy(leaves)
        names = [ids[k] for k in order.tolist()]
        roots = np.arange(1)
        self._pair(levels, len(levels) - 1, 0, len(self.tree.levels) - 1, roots, lowest, names)

    def _pair(self, levels, level: int, node: int, item_level: int, items: np.ndarray, lowest: Level, names: list) -> None:
        """Meet a node of documents with nodes of items of one level."""
        own = levels[level]
        entries = slice(own.first[node], own.first[node + 1])
        self.maxima[own.term[entries]] = own.value[entries]
        while True:
            bound = self.tree.levels[item_level].bounds(items, self.maxima)
            items = items[bound * _SLACK >= self.floor[item_level][items]]
            # At a leaf of documents the items' hierarchy is followed to its end, above it by one level.
            if len(items) == 0 or item_level == 0 or level > 0:
                break
            item_level, items = item_level - 1, self._children(item_level, items)
        self.maxima[own.term[entries]] = 0
        if len(items) == 0:
            return
        if level == 0:
            self._score(node, items, own.term[entries], lowest, names)
            return
        if item_level > 0:
            item_level, items = item_level - 1, self._children(item_level, items)
        for child in range(node * FAN_OUT, min((node + 1) * FAN_OUT, len(levels[level - 1].first) - 1)):
            self._pair(levels, level - 1, child, item_level, items, lowest, names)

    def _children(self, item_level: int, items: np.ndarray) -> np.ndarray:
        below = (items[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
        return below[below < len(self.tree.levels[item_level - 1].first) - 1]

    def _score(self, leaf: int, items: np.ndarray, terms: np.ndarray, lowest: Level, names: list) -> None:
        """All scores of a leaf's documents with some items."""
        low, high = leaf * LEAF, min((leaf + 1) * LEAF, len(names))
        kind = float if self.tree.most < _EXACT else np.int64
        terms = np.unique(terms)
        self.place[:] = -1
        self.place[terms] = np.arange(len(terms))
        held = np.zeros((high - low, len(terms)), dtype=kind)
        entries = slice(lowest.first[low], lowest.first[high])
        held[np.repeat(np.arange(high - low), np.diff(lowest.first[low : high + 1])), self.place[lowest.term[entries]]] = lowest.value[entries]
        own = self.tree.levels[0]
        at, cut = _rows_of(own.first, items)
        column = np.repeat(np.arange(len(items)), np.diff(cut))
        row = self.place[own.term[at]]
        asked = np.zeros((len(terms), len(items)), dtype=kind)
        asked[row[row >= 0], column[row >= 0]] = own.value[at][row >= 0]
        score = held @ asked
        self.scored += score.size
        good = score >= self.floor[0][items]
        for k in np.flatnonzero(good.any(axis=0)).tolist():
            item = int(items[k])
            found = np.flatnonzero(good[:, k])
            kept = self.best[item] + [(-int(score[d, k]), names[low + d] is None, names[low + d]) for d in found.tolist()]
            kept.sort(key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))
            self.best[item] = kept[: self.top]
            self._raise(item)

    def found(self) -> Iterator[tuple]:
        """Rows (item's place in its block, document's id, score)."""
        for place, kept in enumerate(self.best):
            for score, _, name in kept:
                yield int(self.tree.order[place]), name, -score


def _search(projected: DataFrame, tree, totals: tuple[int, int], weights, floors, top: int) -> DataFrame:
    """Rows (place, doc_id, score): what the tasks find."""
    documents, terms = totals
    shared = projected.sparkSession.sparkContext.broadcast((tree, weights, floors))
    id_field = projected.schema.fields[0]
    schema = StructType([StructField("place", LongType()), id_field, StructField("score", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Search(*shared.value, top)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            n = batch.column(1).to_numpy()
            term, size = _joined(batch.column(2), np.int32)
            times = _joined(batch.column(3), np.int32)[0].astype(np.int64)
            impact = impacts(times, np.repeat(n, size), documents, terms)
            own.add(batch.column(0).to_pylist(), n, term.astype(np.int64), size, impact)
        if kind is not None:
            rows = list(own.found())
            columns = [[r[k] for r in rows] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())], names=schema.names
            )

    return projected.filter(F.length("terms") > 0).mapInArrow(run, schema)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, block: list, id_col: str, text_col: str, top: int) -> DataFrame:
    """The results of a block of items: rows (place, doc_id, score, rank)."""
    own = [np.frombuffer(bytes(r["terms"]), dtype=np.uint64) for r in block]
    vocabulary = np.unique(np.concatenate(own))
    projected = _project(docs, vocabulary, id_col, text_col)
    totals = projected.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = term_weights(_document_counts(projected, len(vocabulary)), totals[0])
    tree = ItemTree([np.searchsorted(vocabulary, t) for t in own], weights)
    floors = np.zeros(len(block))
    if totals[0] > 2 * FIRST:
        share = projected.withColumn("__row", F.monotonically_increasing_id()).filter(hash_share("__row", FIRST, totals[0]))
        first = _ranked(_search(share.drop("__row"), tree, totals, weights, floors, top), top)
        for row in first.filter(F.col("rank") == top).select("place", "score").collect():
            floors[row["place"]] = row["score"]
    return _ranked(_search(projected, tree, totals, weights, floors, top), top)


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``top`` documents of each item by score: item_id, rank, doc_id and score.

    Items are broadcast in blocks of ``block_terms`` terms and at most one
    item more, one scan of the documents for each block.
    """
    asked = running_blocks(item_terms(items, item_id, item_text).filter(F.col("size") > 0), "size", block_terms)
    parts = []
    for number in sorted(r["block"] for r in asked.select("block").distinct().collect()):
        block = asked.filter(F.col("block") == number).orderBy("row").select("row", "terms").collect()
        rows = docs.sparkSession.createDataFrame([(k, r["row"]) for k, r in enumerate(block)], "place long, row long")
        found = _search_block(docs, block, doc_id, doc_text, top)
        parts.append(found.join(F.broadcast(rows), "place").select("row", "rank", "doc_id", "score"))
    id_field = docs.schema[doc_id].dataType
    columns = [F.col("item_id"), F.col("rank"), F.col("doc_id"), F.col("score")]
    if not parts:
        schema = StructType([asked.schema["item_id"]]).add("rank", "integer").add("doc_id", id_field).add("score", "long")
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts).join(asked.select("row", "item_id"), "row").select(*columns)


def benchmark_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked_documents(docs, benchmark)

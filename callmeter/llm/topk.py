"""Exact search of greatest integer inner products: blocks by descending length, pruned by residual bounds.

Vectors are turned into whole numbers, floor(1024 x) per component, and sorted
by length into blocks. A rotation by the right singular vectors of a sample of
blocks moves most of the length into the first coordinates. For a pair of a
query block and a candidate block, the product of the first coordinates plus
that of the remaining lengths (Cauchy-Schwarz) bounds each inner product;
pairs of vectors whose bound stays below the query's tenth best score so far
are dropped, and so is the rest of a block whose lengths are too small. What
remains is computed exactly, in whole numbers. The rotation only prunes.

Each query block first meets the few longest blocks, which gives every query a
floor. Floor over length says how long a candidate must be to matter, so a
query block goes to the leading stripes of candidate blocks only; block numbers
and lengths decide that, before any vector is shuffled. Groups of query blocks
meet whole stripes, so a vector is sent once for many pairs of blocks.

Vectors that are null, or hold a null or non-finite component, take no part.
Vectors of different dimensions meet over their common first components.
Scores are exact as long as they fit in 64 bits. Every row is a vector of its
own, repeated ids too; null ids are no queries and come last among ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.llm.linear import hash_share
from callmeter.operators.durable import cut_lineage

SCALE = 1024
TOP = 10
# Vectors in a block, and query vectors in one.
BLOCK = 2048
QUERY_BLOCK = 1024
# Candidate blocks in a stripe, and query blocks in a group: what a task holds at a time.
STRIPE = 16
GROUP = 16
# Longest blocks that give the first floors.
FIRST = 2
# Vectors that the rotation is fitted on, at most about so many.
SAMPLE = 32_768
# Coordinates of the partial product.
LEADING = 16
# Products above this are not exact in floating point.
_EXACT = 2.0**52
_BLOCK_SCHEMA = "block long, size int, dim int, longest double, ids binary, rows binary, vectors binary"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (row, id, vector, length): usable vectors in whole numbers, stored."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x")).dropna(subset=["x"])
    rows = rows.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    rows = rows.select("id", F.transform("x", lambda v: F.floor(v.cast("double") * SCALE)).alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    return cut_lineage(
        rows.select(F.monotonically_increasing_id().alias("row"), "id", "vector", F.sqrt(squares).alias("length"))
    )


def _blocks(whole: DataFrame, size: int) -> DataFrame:
    """The vectors in blocks of like length, longest first within a block, as rows of ``_BLOCK_SCHEMA``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, min(size, batch.num_rows - low))
                lists = part.column(2)
                dims = np.diff(lists.offsets.to_numpy())
                matrix = np.zeros((part.num_rows, int(dims.max(initial=0))), dtype=np.int64)
                matrix[np.arange(matrix.shape[1]) < dims[:, None]] = lists.flatten().to_numpy()
                ids = part.column(1).fill_null(np.iinfo(np.int64).max).to_numpy()
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [number],
                        "size": pa.array([part.num_rows], pa.int32()),
                        "dim": pa.array([matrix.shape[1]], pa.int32()),
                        "longest": [float(part.column(3)[0].as_py())],
                        "ids": [ids.tobytes()],
                        "rows": [part.column(0).to_numpy().tobytes()],
                        "vectors": [matrix.tobytes()],
                    }
                )
                number += 1

    sorted_ = whole.repartitionByRange(F.desc("length"), F.xxhash64("row")).sortWithinPartitions(F.desc("length"), "row")
    return sorted_.select("row", "id", "vector", "length").mapInArrow(pack, _BLOCK_SCHEMA)


class _Block:
    def __init__(self, batch: pa.RecordBatch, i: int, dim: int, names: str = ""):
        get = lambda name: batch.column(batch.schema.get_field_index(names + name))[i].as_py()
        self.size, own = get("size"), get("dim")
        self.longest = get("longest")
        self.ids = np.frombuffer(get("ids"), np.int64)
        self.rows = np.frombuffer(get("rows"), np.int64)
        self.vectors = np.zeros((self.size, dim), dtype=np.int64)
        self.vectors[:, :own] = np.frombuffer(get("vectors"), np.int64).reshape(self.size, own)
        self.floats = self.vectors.astype(float)
        self.length = np.sqrt((self.floats**2).sum(axis=1))
        self.largest = np.abs(self.floats).max(initial=0)

    def rotate(self, rotation: np.ndarray) -> None:
        turned = self.floats @ rotation
        self.leading = turned[:, :LEADING]
        self.residual = np.sqrt((turned[:, LEADING:] ** 2).sum(axis=1))


class _Best:
    """The best candidates so far of the queries of a block."""

    def __init__(self, queries: _Block, top: int, least: np.ndarray | None = None):
        """``least`` are scores that the results are known to reach."""
        self.top = top
        self.least = np.full(queries.size, -np.inf) if least is None else least
        self.score = np.full((queries.size, top), np.iinfo(np.int64).min)
        self.id = np.full((queries.size, top), np.iinfo(np.int64).max)
        self.filled = np.zeros((queries.size, top), dtype=bool)

    def floor(self) -> np.ndarray:
        """A score that a candidate must reach; minus infinity where places are free."""
        return np.maximum(self.least, np.where(self.filled[:, -1], self.score[:, -1].astype(float), -np.inf))

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        order = np.argsort(query, kind="stable")
        query, ids, score = query[order], ids[order], score[order]
        at = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else []
        for low, high in zip(at, np.append(at[1:], len(query)), strict=True) if len(query) else ():
            q = query[low]
            own = self.filled[q]
            scores = np.concatenate([self.score[q][own], score[low:high]])
            names = np.concatenate([self.id[q][own], ids[low:high]])
            kept = np.lexsort((names, -scores))[: self.top]
            self.score[q, : len(kept)], self.id[q, : len(kept)] = scores[kept], names[kept]
            self.filled[q, : len(kept)] = True


def search_block(best: _Best, queries: _Block, candidates: _Block) -> int:
    """Take the candidates' block into ``best``; returns how many pairs were computed in full."""
    floor = best.floor()
    # The block is sorted by length: beyond some row no candidate can reach any query's floor.
    reach = np.where(queries.length > 0, floor / np.maximum(queries.length, 1e-300), np.where(floor > 0, np.inf, -np.inf))
    use = int(np.searchsorted(-candidates.length, -(reach.min(initial=np.inf) * (1 - 1e-9) - 1e-6), "right"))
    if use == 0:
        return 0
    slack = 1e-9 * queries.length[:, None] * candidates.length[None, :use] + 1e-6
    bound = queries.leading @ candidates.leading[:use].T
    bound += queries.residual[:, None] * candidates.residual[None, :use]
    possible = bound + slack >= floor[:, None]
    possible &= queries.rows[:, None] != candidates.rows[None, :use]
    q, c = np.nonzero(possible)
    exact = queries.largest * candidates.largest * max(1, queries.vectors.shape[1]) < _EXACT
    if exact and len(q) > 0.1 * possible.size:
        score = (queries.floats @ candidates.floats[:use].T)[q, c].astype(np.int64)
    else:
        score = np.empty(len(q), dtype=np.int64)
        for low in range(0, len(q), 1 << 16):
            part = slice(low, low + (1 << 16))
            score[part] = (queries.vectors[q[part]] * candidates.vectors[c[part]]).sum(axis=1)
    good = score >= floor[q]
    best.add(q[good], candidates.ids[c[good]], score[good])
    return len(q)


def _rotation(blocks: DataFrame, dim: int, vectors: int) -> np.ndarray:
    """Right singular vectors of a sample of the vectors, by descending singular value."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for i in range(batch.num_rows):
                floats = _Block(batch, i, dim).floats
                total += floats.T @ floats
        yield pa.RecordBatch.from_pydict({"gram": [total.tobytes()]})

    sample = blocks.filter(hash_share("block", SAMPLE, vectors)).coalesce(8)
    total = np.eye(dim) * 1e-9
    for row in sample.mapInArrow(gram, "gram binary").collect():
        total += np.frombuffer(bytes(row["gram"])).reshape(dim, dim)
    values, turned = np.linalg.eigh(total)
    return np.ascontiguousarray(turned[:, np.argsort(-values)])


def _reach(queries: _Block, floor: np.ndarray) -> float:
    """The length below which no candidate can reach any query's floor."""
    need = np.where(queries.length > 0, floor / np.maximum(queries.length, 1e-300), np.where(floor > 0, np.inf, -np.inf))
    return float(need.min(initial=np.inf) * (1 - 1e-9) - 1e-6) if queries.size else np.inf


def _with_floors(queries: DataFrame, blocks: DataFrame, order: list, rotation, dim: int, top: int) -> DataFrame:
    """The query blocks with the floors that the longest candidate blocks give their queries, and how long others must be."""
    longest = blocks.filter(F.col("block").isin([r["block"] for r in order[:FIRST]])).toArrow()
    shared = blocks.sparkSession.sparkContext.broadcast(longest)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = [_Block(batch, i, dim) for batch in shared.value.to_batches() for i in range(batch.num_rows)]
        for block in first:
            block.rotate(rotation.value)
        first.sort(key=lambda b: -b.longest)
        for batch in batches:
            for i in range(batch.num_rows):
                held = _Block(batch, i, dim)
                held.rotate(rotation.value)
                best = _Best(held, top)
                for block in first:
                    search_block(best, held, block)
                floor = best.floor()
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns, pa.array([floor.tobytes()]), pa.array([_reach(held, floor)])],
                    names=[*batch.schema.names, "floors", "reach"],
                )

    return cut_lineage(queries.mapInArrow(search, f"{_BLOCK_SCHEMA}, floors binary, reach double"))


def _meetings(blocks: list, queries: list) -> tuple[list, list]:
    """Which groups of query blocks meet which stripes, from block numbers and lengths alone.

    Rows (block, stripe, groups) and (block, group, stripes): candidate blocks,
    longest first, fall into stripes; query blocks, those that reach shortest
    first, into groups. A group meets the first stripes, a stripe the first
    groups.
    """
    longest = np.array([-r["longest"] for r in blocks])
    groups = [queries[low : low + GROUP] for low in range(0, len(queries), GROUP)]
    reached = [int(np.searchsorted(longest, -min(r["reach"] for r in own), "right")) for own in groups]
    stripes = [-(-n // STRIPE) for n in reached]
    asked = [(r["block"], g, stripes[g]) for g, own in enumerate(groups) for r in own if stripes[g]]
    # Groups are in order of reach, so those that meet a stripe are the first ones.
    held = [(r["block"], k // STRIPE, sum(n > k // STRIPE for n in stripes)) for k, r in enumerate(blocks)]
    return [h for h in held if h[2]], asked


def top_inner_products(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP
) -> DataFrame:
    """Per query its ``top`` greatest scores: query_id, rank, vec_id and score.

    ``is_query`` is a condition on the column ``id``. Equal scores rank by the
    smaller id. Fewer candidates give fewer rows, an empty table none. The
    driver holds one number and one length per block of vectors.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vector_col)
    size = whole.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    dim = max(1, size[1] or 1)
    blocks = cut_lineage(_blocks(whole, BLOCK))
    rotation = spark.sparkContext.broadcast(_rotation(blocks, dim, size[0]))
    order = blocks.select("block", "longest").orderBy(F.desc("longest"), "block").collect()
    queries = _with_floors(_blocks(whole.filter(is_query), QUERY_BLOCK), blocks, order, rotation, dim, top)
    reach = queries.select("block", "reach").orderBy("reach", "block").collect()
    held, asked = _meetings(order, reach)

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        turn = rotation.value
        found = [_Block(batch, i, dim) for batch in candidates.to_batches() for i in range(batch.num_rows)]
        found.sort(key=lambda b: -b.longest)
        for block in found:
            block.rotate(turn)
        out = []
        for batch in queries.to_batches():
            for i in range(batch.num_rows):
                own = _Block(batch, i, dim)
                own.rotate(turn)
                floors = batch.column(batch.schema.get_field_index("floors"))[i].as_py()
                best = _Best(own, top, np.frombuffer(floors, np.float64))
                for block in found:
                    search_block(best, own, block)
                out.append(_found(own, best))
        return pa.Table.from_batches(out, _FOUND_SCHEMA)

    keys = ("stripe", "group")
    stripes = spark.createDataFrame(held, "block long, stripe int, groups int")
    stripes = stripes.select("block", "stripe", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))
    groups = spark.createDataFrame(asked, "block long, group int, stripes int")
    groups = groups.select("block", "group", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)).alias("stripe"))
    left = blocks.join(stripes, "block").groupBy(*keys)
    right = queries.drop("reach").join(groups, "block").groupBy(*keys)
    partial = left.cogroup(right).applyInArrow(search, "q_row long, query_id long, vec_id long, score long")
    ranked = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    last = (1 << 63) - 1
    return ranked.select("query_id", "rank", F.when(F.col("vec_id") != last, F.col("vec_id")).alias("vec_id"), "score")


_FOUND_SCHEMA = pa.schema([(name, pa.int64()) for name in ("q_row", "query_id", "vec_id", "score")])


def _found(queries: _Block, best: _Best) -> pa.RecordBatch:
    q, k = np.nonzero(best.filled)
    return pa.RecordBatch.from_pydict(
        {"q_row": queries.rows[q], "query_id": queries.ids[q], "vec_id": best.id[q, k], "score": best.score[q, k]}
    )


def embedding_neighbours(vectors: DataFrame) -> DataFrame:
    """The search with every vector whose id is divisible by 100 as a query."""
    return top_inner_products(vectors, F.col("id") % 100 == 0)

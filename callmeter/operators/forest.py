"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) on Spark.

Spark draws one bounded sample per tree and ships each to the task that grows
it; rows are scored in Arrow batches against the node table. Only the node
table, at most ``trees * (2 * sample - 1)`` rows, passes through the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.operators.quantile import exact_quantile

# The functions below travel to the executors with the tasks that call them,
# so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Hash values are compared as fractions of this.
_HASH_RANGE = 1 << 40
# Each tree is offered this many times its sample, and keeps the lowest hashes.
_OVERDRAW = 4

_ARRAYS = {"feature": np.int32, "threshold": float, "left": np.int32, "right": np.int32, "path": float}

_NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path double, sampled int"
)


def mean_path(size: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``size`` points: 2 H(n-1) - 2 (n-1) / n."""
    n = np.atleast_1d(np.asarray(size, dtype=float))
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(points: np.ndarray, rng: np.random.Generator, height: int) -> list[tuple]:
    """Nodes (feature, threshold, left, right, path) of one tree; leaves have feature -1."""
    nodes: list[tuple] = [()]
    todo = [(0, points, 0)]
    while todo:
        at, rows, depth = todo.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        open_features = np.flatnonzero(high > low) if len(rows) > 1 and depth < height else ()
        if len(open_features) == 0:
            nodes[at] = (-1, 0.0, at, at, depth + float(mean_path(len(rows))[0]))
            continue
        feature = int(rng.choice(open_features))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = rows[:, feature] <= threshold
        left, right = len(nodes), len(nodes) + 1
        nodes += [(), ()]
        nodes[at] = (feature, threshold, left, right, 0.0)
        todo += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


def scores(points: np.ndarray, nodes: dict[str, np.ndarray], sample: int, height: int) -> np.ndarray:
    """Minus the anomaly score of each point: near -1 is anomalous, about -0.5 is normal.

    All points walk down all trees together, one level at a time.
    """
    trees = np.arange(nodes["feature"].shape[0])[None, :]
    at = np.zeros((len(points), trees.shape[1]), dtype=np.int32)
    rows = np.arange(len(points))[:, None]
    for _ in range(height):
        value = points[rows, np.maximum(nodes["feature"][trees, at], 0)]
        goes_left = value <= nodes["threshold"][trees, at]
        at = np.where(goes_left, nodes["left"][trees, at], nodes["right"][trees, at])
    depth = nodes["path"][trees, at].mean(axis=1)
    scale = float(mean_path(sample)[0]) or 1.0
    return -np.power(2.0, -depth / scale)


@dataclass
class IsolationForest:
    """A grown forest: node arrays of shape (trees, nodes), by name."""

    columns: tuple[str, ...]
    nodes: dict[str, np.ndarray]
    sample: int
    height: int

    def scores(self, points: np.ndarray) -> np.ndarray:
        return scores(points, self.nodes, self.sample, self.height)

    def score_column(self, df: DataFrame) -> Column:
        """The score as a column of ``df``; only the feature columns go to Python."""
        model = df.sparkSession.sparkContext.broadcast((self.nodes, self.sample, self.height))

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(scores(batch.to_numpy(dtype=float), *model.value), index=batch.index)

        return score(F.struct(*[F.col(c).cast("double").alias(c) for c in self.columns]))


def _fraction(*parts: Column | str) -> Column:
    """A reproducible number in [0, 1) from the hash of the given columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(_HASH_RANGE)) / F.lit(float(_HASH_RANGE))


def draw_samples(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], trees: int, sample: int, seed: int
) -> DataFrame:
    """Rows offered to each tree, with the hash that orders them.

    Every tree draws from all rows, by a hash of its own. It is offered about
    four times its sample, so the number of rows shuffled does not grow with
    the table.
    """
    share = F.lit(min(1.0, _OVERDRAW * sample / max(df.count(), 1)))
    offered = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: _fraction(*keys, tree, F.lit(seed)) < share,
    )
    values = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    return df.select(*keys, *values, F.explode(offered).alias("tree")).select(
        "tree",
        _fraction(*keys, "tree", F.lit(seed)).alias("_order"),
        F.xxhash64(*keys).alias("_tie"),
        *[f"x{i}" for i in range(len(columns))],
    )


def fit(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    trees: int = 200,
    sample: int = 256,
    seed: int = 42,
) -> IsolationForest:
    """Grow a forest on ``columns`` of ``df``, whose rows ``keys`` identify.

    The same rows, keys and seed give the same forest. ``df`` is read twice;
    give it as a table or a checkpoint.
    """
    width = len(columns)

    def grow_tree(key: tuple, offered: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        kept = offered.sort_values(["_order", "_tie"]).head(sample)
        points = kept[[f"x{i}" for i in range(width)]].to_numpy(dtype=float)
        height = math.ceil(math.log2(max(len(points), 2)))
        nodes = grow(points, np.random.default_rng([seed, tree]), height)
        table = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "path"])
        return table.assign(tree=tree, node=range(len(table)), sampled=len(points))[
            ["tree", "node", "feature", "threshold", "left", "right", "path", "sampled"]
        ]

    offered = draw_samples(df, columns, keys, trees, sample, seed)
    nodes = offered.groupBy("tree").applyInPandas(grow_tree, _NODE_SCHEMA).toPandas()
    if nodes.empty:
        raise ValueError("no rows to grow a forest on")
    # Row numbers of the arrays are the trees that received rows, in order.
    slot = nodes["tree"].rank(method="dense").astype(int).to_numpy() - 1
    shape = (int(slot.max()) + 1, int(nodes["node"].max()) + 1)

    def packed(name: str, dtype) -> np.ndarray:
        array = np.zeros(shape, dtype=dtype)
        array[slot, nodes["node"].to_numpy()] = nodes[name].to_numpy()
        return array

    sampled = int(nodes["sampled"].max())
    return IsolationForest(
        columns=tuple(columns),
        nodes={name: packed(name, kind) for name, kind in _ARRAYS.items()},
        sample=sampled,
        height=math.ceil(math.log2(max(sampled, 2))),
    )


def save(forest: IsolationForest, spark: SparkSession, path: str) -> None:
    """Write the node table, one row per node, with the forest's parameters in each."""
    trees, nodes = forest.nodes["feature"].shape
    table = pd.DataFrame(
        {
            "tree": np.repeat(np.arange(trees), nodes),
            "node": np.tile(np.arange(nodes), trees),
            **{name: array.ravel() for name, array in forest.nodes.items()},
        }
    )
    described = spark.createDataFrame(table).withColumns(
        {
            "sample": F.lit(forest.sample),
            "height": F.lit(forest.height),
            "columns": F.array(*[F.lit(c) for c in forest.columns]),
        }
    )
    described.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> IsolationForest:
    """Read a node table back; its size is that of the forest, not of any data."""
    table = spark.read.parquet(path).toPandas().sort_values(["tree", "node"])
    shape = (int(table["tree"].max()) + 1, int(table["node"].max()) + 1)
    arrays = {name: table[name].to_numpy().astype(kind).reshape(shape) for name, kind in _ARRAYS.items()}
    first = table.iloc[0]
    return IsolationForest(tuple(first["columns"]), arrays, int(first["sample"]), int(first["height"]))


def flag_share(scored: DataFrame, score: str, flag: str, contamination: float = 0.05) -> DataFrame:
    """Mark rows whose score lies below the exact ``contamination`` quantile."""
    limit = F.lit(exact_quantile(scored, score, contamination))
    return scored.withColumn(flag, (F.col(score) < limit).cast("int"))

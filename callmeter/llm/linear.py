"""Linear models on hashed sparse features, fitted by FTRL-proximal on shards and averaged.

McMahan et al., "Ad click prediction: a view from the trenches" (KDD 2013).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FRACTION = 1 << 30


def id_remainder(col: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % modulus, F.lit(-1))


def hash_share(col: str, bound: int, total: int) -> Column:
    """A condition that a share of ``bound / total`` of the ids meet, decided by their hash."""
    share = min(1.0, bound / max(total, 1))
    return F.pmod(F.xxhash64(F.col(col), F.lit("share")), F.lit(_FRACTION)) < int(share * _FRACTION)


def ftrl(
    examples: Iterable[tuple[np.ndarray, np.ndarray, int]],
    size: int,
    classes: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.01,
    l2: float = 0.01,
    epochs: int = 2,
) -> np.ndarray:
    """Weights of a softmax over ``classes``, or of a logistic model where that is 1.

    An example is its feature ids (each once), their values, and its class (0
    or 1 for the logistic model). The last row of the weights is the intercept.
    """
    z = np.zeros((size + 1, classes))
    n = np.zeros((size + 1, classes))
    examples = list(examples)

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return -np.sign(zs) * np.maximum(np.abs(zs) - l1, 0) / ((beta + np.sqrt(ns)) / alpha + l2)

    for _ in range(epochs):
        for ids, values, label in examples:
            at = np.append(ids, size)
            x = np.append(values, 1.0)[:, None]
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            error = probabilities((x * w).sum(axis=0, keepdims=True))[0]
            if classes == 1:
                error = error - label
            else:
                error[label] -= 1
            g = x * error
            step = (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha
            z[at] = zs + g - step * w
            n[at] = ns + g * g
    return weights(z, n).astype(np.float32)


def probabilities(logits: np.ndarray) -> np.ndarray:
    """Sigmoid of a single column, softmax of several."""
    if logits.shape[1] == 1:
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(sample: DataFrame, examples, size: int, classes: int, shards: int = 8, **settings) -> np.ndarray:
    """Fit a model on each of ``shards`` parts of a bounded sample and average the weights.

    ``sample`` has a column ``shard`` and whatever ``examples(pdf)`` turns into
    examples. Only the averaged weights, ``(size + 1) * classes`` numbers at
    most, reach the driver.
    """

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        w = ftrl(examples(pdf), size, classes, **settings)
        used = np.flatnonzero(w.any(axis=1))
        return pd.DataFrame({"feature": used, "weights": list(w[used].astype(float))})

    parts = sample.groupBy("shard").applyInPandas(train, "feature long, weights array<double>")
    sums = parts.groupBy("feature").agg(
        *(F.sum(F.col("weights")[c]).alias(f"w{c}") for c in range(classes)),
    )
    found = sums.toPandas()
    trained = max(1, shards)
    w = np.zeros((size + 1, classes), dtype=np.float32)
    if len(found):
        # A shard whose weight is zero, and which thus sends no row, counts too.
        w[found["feature"].to_numpy()] = found[[f"w{c}" for c in range(classes)]].to_numpy() / trained
    return w


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over ``first[i]:first[i + 1]`` along the first axis; 0 for empty rows."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), dtype=np.float64)
    filled = np.flatnonzero(np.diff(first))
    if len(filled):
        out[filled] = np.add.reduceat(values, first[filled], axis=0, dtype=np.float64)
    return out

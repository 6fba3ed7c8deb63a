"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's tokens are its words and its runs of marks. Its features are token
uni- and bigrams, and uni- and bigrams of token shapes: case, digits, marks by
length, whether white space comes before, and whether the token repeats the
one before it. A feature's value is its share of all tokens, so that a score
is a mean of weights, whatever the length of the text.

Nulls and empty texts have no features and get the score of the intercept. A
document with several labels counts as their mean, rounded half up. Without
labels, or with labels of one kind only, scores follow from the intercept. An
empty table gives no rows. A score depends on the text alone, not on the rows
beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from callmeter.llm.linear import fit, hash_share, id_remainder, probabilities, row_sums
from callmeter.llm.text import MARK, WORD, Hasher, Slice, byte_set, lower, mix, runs, seeds, slices

BITS = 18
SHARDS = 8
# At most about this many labelled documents are learned from.
SAMPLE = 16_000
_SCALE = 16.0
_UPPER = byte_set(lambda b: 65 <= b <= 90)
_DIGIT = byte_set(lambda b: 48 <= b <= 57)
_SHAPES = 32


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, marks: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """A number under 8 for the look of each token, and 8 more after white space or where a row opens."""
    second = data[np.minimum(starts + 1, ends - 1)]
    first = data[starts]
    capital = _UPPER[first] | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    size = ends - starts
    shape = np.where(capital, 1, 0)
    shape = np.where(capital & (size > 1) & _UPPER[data[ends - 1]], 2, shape)
    shape = np.where(_DIGIT[first], 3, shape)
    shape = np.where(marks, 3 + np.minimum(size, 3), shape)
    glued = np.concatenate([[False], starts[1:] == ends[:-1]]) & ~opens
    return shape + np.where(glued, 0, 8)


def features(s: Slice, hasher: Hasher, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of the rows of a slice, in no order within a row, and where each row's begin."""
    spans = [runs(s.data, s.offsets, table) for table in (WORD, MARK)]
    starts = np.concatenate([a for a, _ in spans])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.concatenate([b for _, b in spans])[order]
    marks = order >= len(spans[0][0])
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(len(s.offsets), np.int64)
    hashes = hasher.span(hasher.prefix(lower(s.data)), starts, ends)
    first = np.searchsorted(starts, s.offsets)
    opens = np.zeros(len(starts) + 1, bool)
    opens[first] = True
    opens = opens[:-1]
    previous = np.where(opens, np.uint64(0), np.roll(hashes, 1))
    shape = _shapes(s.data, starts, ends, marks, opens) + np.where(hashes == previous, 16, 0)
    before = np.where(opens, _SHAPES, np.roll(shape, 1))
    a, b, c = seeds(3, salt=5)
    stack = np.empty((len(starts), 4), dtype=np.uint64)
    stack[:, 0] = hashes
    stack[:, 1] = mix(hashes * a + previous * b)
    stack[:, 2] = mix((shape + 1).astype(np.uint64) * c)
    stack[:, 3] = mix((shape * 64 + before + 100).astype(np.uint64) * c)
    return (stack.reshape(-1) >> np.uint64(64 - bits)).astype(np.int64), first * 4


def _examples(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    hasher = Hasher()
    batch = pa.RecordBatch.from_pandas(pdf[["text", "label"]].sample(frac=1.0, random_state=1), preserve_index=False)
    for s in slices([batch]):
        ids, first = features(s, hasher)
        for i, label in enumerate(s.rows.column("label").to_pylist()):
            own, counts = np.unique(ids[first[i] : first[i + 1]], return_counts=True)
            yield own, counts * (_SCALE * 4 / max(1, first[i + 1] - first[i])), label


def fit_quality(
    docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, label: str = "quality", sample: int = SAMPLE
) -> np.ndarray:
    """Weights learned from the labelled ``docs`` that meet ``learn_from``, a bounded sample of them.

    ``sample`` bounds the expected number of documents learned from; which
    ones is decided by a hash of their id.
    """
    marked = labels.select("doc_id", F.col(label).alias("label")).dropna()
    marked = marked.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    if learn_from is not None:
        marked = marked.filter(learn_from)
    chosen = hash_share("doc_id", sample, marked.count())
    rows = docs.select("doc_id", "text").filter(chosen & F.col("text").isNotNull())
    rows = rows.join(marked.filter(chosen), "doc_id")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)))
    return fit(rows.select("text", "label", "shard"), _examples, 1 << BITS, 1, SHARDS)


def score_quality(
    docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The columns ``keep`` and the chance that a text is of label 1. Null texts count as empty."""
    broadcast = docs.sparkSession.sparkContext.broadcast(weights[:, 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = Hasher(), broadcast.value
        for s in slices(batches, "__text"):
            ids, first = features(s, hasher)
            sums = row_sums(w[ids], first) * (_SCALE * 4 / np.maximum(1, np.diff(first)))
            score = probabilities((sums + w[-1])[:, None])[:, 0]
            columns = s.rows.columns[: len(keep)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*keep, name])

    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = StructType([*rows.schema.fields[:-1], StructField(name, DoubleType())])
    return rows.mapInArrow(run, schema)


def learnable() -> Column:
    return id_remainder("doc_id", 3) != 1


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted, by a model that held-out documents had no part in."""
    scored = score_quality(docs, fit_quality(docs, labels, learnable()))
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least 0.5."""
    scored = score_quality(docs, fit_quality(docs, labels, learnable()), tuple(docs.columns), "__score")
    return scored.filter(F.col("__score") >= 0.5).select(*docs.columns)

"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Characters are folded to lower case (A to Z and Latin-1), n-grams of one to
three of them are hashed, and a text is the mean of the inverse document
frequencies of its n-grams. Weights are trained by follow-the-regularised-
leader with an elastic net; a temperature, fitted on documents set aside,
calibrates the probabilities. Document frequencies count all documents learned from.

Null texts and texts without a letter are ``und`` with score 0; so is every
text if there is nothing to learn from. Repeated rows count each; rows of null
id are learned from all or none, as their ids have one hash, and an empty table
gives no rows. The languages are the distinct non-null
values of ``lang`` among the documents learned from; of equal scores the
alphabetically first wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from callmeter.llm.linear import fit, hash_share, id_remainder, probabilities, row_sums
from callmeter.llm.text import Slice, lower, slices

UNDETERMINED = "und"
BITS = 15
ORDERS = 3
SHARDS = 8
# At most about this many documents are learned from, beside the document frequencies.
SAMPLE = 12_000
_SCALE = 30.0
_TEMPERATURES = np.geomspace(0.2, 20, 47)
_M = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    temperature: float = 1.0

    def parts(self) -> tuple:
        """Plain values, which executors can read without this package."""
        return self.languages, self.weights, self.temperature


def char_grams(s: Slice, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the hashed n-grams of the rows of a slice, and where each row's begin."""
    data = lower(s.data)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.uint32)
    spare = np.concatenate([data, np.zeros(3, np.uint8)])
    for low, k in ((0xC0, 1), (0xE0, 2), (0xF0, 3)):
        wide = np.flatnonzero(data[at] >= low)
        code[wide] = code[wide] * np.uint32(257) + spare[at[wide] + k]
    first = np.searchsorted(at, s.offsets)
    gram = np.zeros(len(code), np.uint32)
    for n in range(1, ORDERS + 1):
        size = max(0, len(code) - n + 1)
        gram = gram[:size] + code[n - 1 :] * _M[n - 1]
        bucket = ((gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)) >> np.uint32(32 - bits)
        # Leave out grams that run over a row's end.
        inner = np.ones(size, bool)
        for back in range(1, n):
            edge = first[1:-1] - back
            inner[edge[(edge >= 0) & (edge < size)]] = False
        where = np.concatenate([[0], np.cumsum(inner)])
        yield bucket[inner], where[np.minimum(first, size)]


def _document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, and the number of documents."""
    size = 1 << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(size, np.int64), 0
        for s in slices(batches):
            rows += s.rows.num_rows
            grams = list(char_grams(s))
            for i in range(s.rows.num_rows):
                seen = np.zeros(size, bool)
                for bucket, first in grams:
                    seen[bucket[first[i] : first[i + 1]]] = True
                found += seen
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bucket": np.append(at, -1), "n": np.append(found[at], rows)})

    counts = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    out = np.zeros(size, np.int64)
    real = table[table["bucket"] >= 0]
    out[real["bucket"].to_numpy(dtype=np.int64)] = real["n"]
    return out, int(table.loc[table["bucket"] < 0, "n"].sum())


def _logits(s: Slice, model: LanguageModel) -> np.ndarray:
    total = np.zeros((s.rows.num_rows, len(model.languages)))
    count = np.zeros(s.rows.num_rows)
    for bucket, first in char_grams(s):
        total += row_sums(model.weights[bucket], first)
        count += np.diff(first)
    return (total / np.maximum(count, 1)[:, None] + model.weights[-1]) / model.temperature


def _learners(docs: DataFrame, learn_from: Column | None) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang").dropna(subset=["text", "lang"])
    return rows.filter(learn_from) if learn_from is not None else rows


def fit_language(docs: DataFrame, learn_from: Column | None = None, sample: int = SAMPLE) -> LanguageModel:
    """A model learned from the ``docs`` that meet ``learn_from``.

    Document frequencies and languages come from all of them, the weights from
    a share of them by a hash of the id, about ``sample`` documents.
    """
    rows = _learners(docs, learn_from)
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], np.zeros((1, 0), np.float32))
    size, classes = 1 << BITS, len(languages)
    df, total = _document_frequencies(rows)
    idf = np.log((1 + total) / (1 + df)) + 1
    chosen = rows.filter(hash_share("doc_id", sample, total))
    slot = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(10 * SHARDS))
    chosen = chosen.withColumn("slot", slot)
    number = {lang: i for i, lang in enumerate(languages)}

    def examples(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        part = pdf[["text", "lang"]].sample(frac=1.0, random_state=1)
        for s in slices([pa.RecordBatch.from_pandas(part, preserve_index=False)]):
            grams = list(char_grams(s))
            for i, lang in enumerate(s.rows.column("lang").to_pylist()):
                own = np.concatenate([bucket[first[i] : first[i + 1]] for bucket, first in grams])
                ids, counts = np.unique(own, return_counts=True)
                yield ids.astype(np.int64), counts * idf[ids] * (_SCALE / max(1, len(own))), number[lang]

    # One document in ten is set aside for the temperature.
    training = chosen.filter(F.col("slot") >= SHARDS).withColumn("shard", F.col("slot") % SHARDS)
    w = fit(training.select("text", "lang", "shard"), examples, size, max(2, classes), SHARDS, l1=0.02, l2=0.02)
    w = w[:, :classes]
    w[:-1] *= (idf * _SCALE)[:, None].astype(np.float32)
    model = LanguageModel(languages, w)
    model.temperature = _fit_temperature(chosen.filter(F.col("slot") < SHARDS), model)
    return model


def _fit_temperature(rows: DataFrame, model: LanguageModel) -> float:
    """The temperature of least log loss; 1 if there are no rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = np.zeros(len(_TEMPERATURES))
        held = LanguageModel(*shared.value)
        number = {lang: i for i, lang in enumerate(held.languages)}
        for s in slices(batches):
            truth = np.array([number[x] for x in s.rows.column("lang").to_pylist()])
            logits = _logits(s, held)
            for k, t in enumerate(_TEMPERATURES):
                scaled = logits / t
                top = scaled.max(axis=1)
                norm = top + np.log(np.exp(scaled - top[:, None]).sum(axis=1))
                loss[k] += (norm - scaled[np.arange(len(truth)), truth]).sum()
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(loss)), "loss": loss})

    sums = rows.select("text", "lang").mapInArrow(run, "k long, loss double").groupBy("k").agg(F.sum("loss").alias("loss"))
    table = sums.toPandas()
    if len(table) == 0 or table["loss"].max() == 0:
        return 1.0
    return float(_TEMPERATURES[int(table.sort_values(["loss", "k"])["k"].iloc[0])])


def score_language(
    docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep``, the likeliest language and its calibrated probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*shared.value)
        languages = np.array([*m.languages, UNDETERMINED], dtype=object)
        for s in slices(batches, "__text"):
            known = s.rows.column("__letter").to_numpy(zero_copy_only=False).astype(bool)
            if m.languages:
                p = probabilities(_logits(s, m)) if len(m.languages) > 1 else np.ones((s.rows.num_rows, 1))
                best, score = p.argmax(axis=1), p.max(axis=1)
            else:
                best, score, known = np.zeros(len(known), int), np.zeros(len(known)), known & False
            best, score = np.where(known, best, len(m.languages)), np.where(known, score, 0.0)
            columns = [*s.rows.columns[: len(keep)], pa.array(languages[best], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letter")
    rows = docs.select(*keep, F.col("text").alias("__text"), letter)
    added = [StructField(names[0], StringType()), StructField(names[1], DoubleType())]
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-2], *added]))


def learnable() -> Column:
    return id_remainder("doc_id", 4) != 2


def language_scores(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score, by a model that held-out documents had no part in."""
    scored = score_language(docs, fit_language(docs, learnable()))
    return scored.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with a probability of at least ``least``."""
    scored = score_language(docs, fit_language(docs, learnable()), tuple(docs.columns), ("__lang", "__score"))
    return scored.filter((F.col("__lang") != UNDETERMINED) & (F.col("__score") >= least)).select(*docs.columns)

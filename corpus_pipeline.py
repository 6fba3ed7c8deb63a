"""A corpus pipeline on the documents: filters, deduplicates, decontaminates and packs them.

``run`` writes each stage's result as Parquet to the session's checkpoint
folder and reads it again for the next stage, so that a lost executor costs
work of one stage only. These tables are the result's lineage and stay until
the folder is cleared.

Null and empty texts go with the quality classifier's judgement of an empty
text, and where it accepts them with the language filter, as they have no
letter. Rows of null id take part like others. Repeated rows are near
duplicates of each other, so one of them stays: that of least id, null ids
last. Any text that stays is packed whole, whatever its length. Extra columns
are kept up to the last stage. An empty table gives an empty result, and a
stage without labels, benchmark items or languages to learn from follows its
operator's definition for that case.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from callmeter.llm import decontaminate, langid, ngram_join, packing, quality
from callmeter.llm.text import bound_batches
from callmeter.operators.durable import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_quality(docs, bound_batches(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    bound_batches(spark)
    return langid.keep_identified(docs)


def deduplication_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of least id."""
    bound_batches(spark)
    return ngram_join.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, bound_batches(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences."""
    bound_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack_documents(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", deduplication_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
# Two stages are learned, and alignment is beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the table ``documents`` to the result of the last one."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside, as extra columns of the input.
CLASHING = (
    "score", "word", "row", "fp", "n", "label", "shard", "bucket", "count", "bands", "rank", "id", "held_out", "key", "block", "template"
)


def sentence(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}{chr(97 + rng.randrange(26))}" for _ in range(words))


def awkward_rows() -> list[tuple]:
    rng = random.Random(5)
    long = sentence(rng, 6000)
    return [
        (1, "plain words of a text", "en", "a", 21),
        (1, "plain words of a text", "en", "a", 21),
        (2, None, "en", None, None),
        (3, "", None, "a", 0),
        (4, " \n\t ", "de", "a", 4),
        (None, "a text without an id", "de", "b", 20),
        (None, None, None, None, None),
        (5, long, "en", "b", len(long)),
        (6, "12 34 !!", "fr", "b", 8),
        (7, "Ünïcödé 中文 😀 don't", "fr", "c", 18),
        (8, "x" * 3000, "en", "c", 3000),
        (9, "one\u0000two", "en", "c", 7),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)


def clashing(df):
    """The same rows with further columns."""
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("clash") for name in CLASHING if name not in df.columns})


def sorted_rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)

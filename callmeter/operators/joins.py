"""Join of a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup of at most this many rows is sent to every executor.
BROADCAST_ROWS = 10_000


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """LEFT join of ``facts`` with a lookup on a key with few, hot values.

    The lookup's size is checked first, by reading no more than
    ``broadcast_rows + 1`` of its rows. A larger one is joined by shuffle with
    the key salted, because a handful of key values would otherwise put all of
    ``facts`` into as many tasks. The salt hashes the whole row and is thus
    the same when a lost task is run again; many copies of one row share a
    salt, and are split by the skew handling of adaptive execution.
    """
    if lookup.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return facts.join(F.broadcast(lookup), key, "left")
    salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    copies = lookup.withColumn("_salt", F.explode(every_salt))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")

"""Exact quantiles of columns of any size."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callmeter.operators.durable import cut_lineage


def exact_quantile(df: DataFrame, col: str, share: float) -> float | None:
    """The value at ``share`` of the way through the sorted non-null values, between two of them in proportion.

    The values are sorted by range into partitions and stored. The sizes of
    the partitions tell in which of them the two values lie, and only those
    are numbered. None if there is no value.
    """
    values = df.select(F.col(col).cast("double").alias("value")).dropna()
    ranged = cut_lineage(values.repartitionByRange("value", F.rand(1)).sortWithinPartitions("value"))
    place = F.spark_partition_id().alias("part")
    sizes = sorted(map(tuple, ranged.groupBy(place).count().collect()))
    total = sum(size for _, size in sizes)
    if not total:
        return None
    position = share * (total - 1)
    low = math.floor(position)
    wanted = []
    before = 0
    for part, size in sizes:
        for at in (low, min(low + 1, total - 1)):
            if before <= at < before + size:
                wanted.append((part, at - before + 1, at))
        before += size
    parts = sorted({part for part, _, _ in wanted})
    number = F.row_number().over(Window.partitionBy("part").orderBy("value")).alias("number")
    ranks = sorted({rank for _, rank, _ in wanted})
    rows = ranged.select("value", place).filter(F.col("part").isin(parts)).select("part", "value", number)
    found = {(r["part"], r["number"]): r["value"] for r in rows.filter(F.col("number").isin(ranks)).collect()}
    value = {at: found[part, rank] for part, rank, at in wanted}
    first, second = value[low], value[min(low + 1, total - 1)]
    return first + (second - first) * (position - low)


def exact_quantiles(df: DataFrame, key: str, value: str, shares: Sequence[float]) -> DataFrame:
    """Rows (key, share, quantile): for each key, as ``exact_quantile`` gives them, all in one sort.

    Values are sorted by key and value over all partitions; the partitions'
    sizes by key, few numbers, tell which places of which partition are wanted,
    and only partitions that hold one are numbered. No buffer holds the values
    of a key.
    """
    values = df.select(F.col(key).alias("key"), F.col(value).cast("double").alias("value")).dropna()
    ranged = cut_lineage(values.repartitionByRange("key", "value", F.rand(1)).sortWithinPartitions("key", "value"))
    place = F.spark_partition_id().alias("part")
    sizes = sorted(map(tuple, ranged.groupBy("key", place).count().collect()))
    totals: dict = defaultdict(int)
    for name, _, size in sizes:
        totals[name] += size
    wanted = []
    before: dict = defaultdict(int)
    for name, part, size in sizes:
        for share in shares:
            position = share * (totals[name] - 1)
            low = math.floor(position)
            for at, weight in ((low, 1 - (position - low)), (min(low + 1, totals[name] - 1), position - low)):
                if before[name] <= at < before[name] + size:
                    wanted.append((name, part, at - before[name] + 1, share, weight))
        before[name] += size
    schema = StructType([values.schema["key"], *StructType.fromDDL("part int, number int, share double, weight double").fields])
    asked = df.sparkSession.createDataFrame(wanted, schema)
    parts = sorted({part for _, part, *_ in wanted})
    number = F.row_number().over(Window.partitionBy("part", "key").orderBy("value")).alias("number")
    rows = ranged.select("key", "value", place).filter(F.col("part").isin(parts)).select("key", "part", "value", number)
    found = rows.join(F.broadcast(asked), ["key", "part", "number"])
    # The lower value and its distance from the upper one: equal values give that very value.
    low, high = F.min("value"), F.max("value")
    share_above = F.max_by("weight", F.col("number") + F.col("part").cast("long") * (1 << 40))
    return found.groupBy("key", "share").agg((low + (high - low) * F.when(low == high, 0.0).otherwise(share_above)).alias("quantile"))

"""Rows in blocks of a bounded total size, each fit for one broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callmeter.operators.durable import cut_lineage


def running_blocks(rows: DataFrame, size_col: str, bound: int) -> DataFrame:
    """Add a column ``block``: the running total of ``size_col`` before each row, in whole multiples of ``bound``.

    The rows of a block exceed ``bound`` by one row's size at most, however
    sizes and copies are spread. ``rows`` has a column ``row`` from
    ``monotonically_increasing_id``, already stored, whose upper bits say
    which partition a row came from; only one total per partition is
    gathered in one place.
    """
    part = F.shiftright("row", 33)
    own = Window.partitionBy("__part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__part", part).withColumn("__before", F.coalesce(F.sum(size_col).over(own), F.lit(0)))
    totals = placed.groupBy("__part").agg(F.sum(size_col).alias("__all"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__part", F.coalesce(F.sum("__all").over(ahead), F.lit(0)).alias("__ahead"))
    block = F.floor((F.col("__ahead") + F.col("__before")) / F.lit(bound)).cast("long")
    return cut_lineage(placed.join(totals, "__part").withColumn("block", block).drop("__part", "__before", "__ahead"))

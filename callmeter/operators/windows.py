"""Row and calendar windows over daily series.

All of them run on daily aggregates, one row per day and team or model. A
window group therefore holds as many rows as there are days of history,
whatever the number of calls behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callmeter.functions.exact import divide_half_up, from_units, to_units


def series(key: str, day: str):
    """Days of one team or model, in order."""
    return Window.partitionBy(key).orderBy(day)


def with_rolling_mean(df: DataFrame, name: str, value: str, places: int, frame) -> DataFrame:
    """Add the mean over a window frame of a value rounded to ``places``, rounded alike."""
    unit = to_units(value, places)
    sums = df.withColumns({"_sum": F.sum(unit).over(frame), "_count": F.count(unit).over(frame)})
    mean = from_units(divide_half_up(F.col("_sum"), F.col("_count")), places)
    return sums.withColumn(name, mean).drop("_sum", "_count")


def last_rows(key: str, day: str, rows: int):
    """This row and the ``rows - 1`` before it, also across missing days."""
    return series(key, day).rowsBetween(1 - rows, 0)


def last_days(key: str, day: str, days: int):
    """This day and the ``days - 1`` calendar days before it."""
    return Window.partitionBy(key).orderBy(F.unix_date(F.col(day))).rangeBetween(1 - days, 0)


def rows_before(key: str, day: str, rows: int):
    """The ``rows`` rows before this one, without it."""
    return series(key, day).rowsBetween(-rows, -1)

"""Small column builders that several plans share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def code_of(col: str, codes: Mapping[str, int]) -> Column:
    """Integer code of a category; NULL for one that is not listed."""
    return F.coalesce(*[F.when(F.col(col) == name, F.lit(code)) for name, code in codes.items()])


def calendar_columns(date_col: str) -> dict[str, Column]:
    """Date parts as the cost model sees them; Monday is 0, weeks are ISO."""
    day = F.col(date_col)
    return {
        "day_of_week": F.weekday(day),
        "day_of_month": F.dayofmonth(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }


def stamped(df: DataFrame, name: str, loaded_at: Column | None) -> DataFrame:
    """Add a load-time column, if a load time is given."""
    return df if loaded_at is None else df.withColumn(name, loaded_at)


def only_teams(df: DataFrame, teams: Sequence[str] | None) -> DataFrame:
    """Rows of the chosen teams; no choice means all of them."""
    return df.filter(F.col("team").isin(list(teams))) if teams else df

"""Exact decimal rounding on long columns.

Money and percentages travel between operators as doubles that were rounded to
a known number of places. Here they are turned back into whole units of the
last place (micro-dollars, hundredths of a percent), so that sums and averages
are integer arithmetic: exact, the same in any order of addition, and cheaper
inside generated code than decimal columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_units(value: Column | str, places: int) -> Column:
    """A double rounded to ``places`` as a long count of 10^-places."""
    col = F.col(value) if isinstance(value, str) else value
    return F.rint(col.cast("double") * F.lit(float(10**places))).cast("long")


def from_units(value: Column | str, places: int) -> Column:
    """A long count of 10^-places as the nearest double."""
    col = F.col(value) if isinstance(value, str) else value
    return col.cast("double") / F.lit(float(10**places))


def divide_half_up(num: Column, den: Column) -> Column:
    """``num / den`` on longs, halves away from zero; NULL for a zero ``den``.

    ``den`` must not be negative. Compares the remainder with what is missing
    to the divisor, so that nothing has to be doubled and could overflow.
    """
    den = F.nullif(den, F.lit(0).cast("long"))
    rest = F.abs(num % den)
    up = F.when(rest >= den - rest, F.when(num < 0, F.lit(-1)).otherwise(F.lit(1))).otherwise(F.lit(0))
    return F.call_function("div", num, den) + up.cast("long")


def drop_places(units: Column, have: int, want: int) -> Column:
    """Round a long count of 10^-have to a long count of 10^-want, with one division."""
    step = 10 ** (have - want)
    if step == 1:
        return units
    half = F.when(units < 0, F.lit(-(step // 2)).cast("long")).otherwise(F.lit(step // 2).cast("long"))
    return F.call_function("div", units + half, F.lit(step).cast("long"))


def sum_places(col: str, have: int, want: int) -> Column:
    """Sum of a column rounded to ``have`` places, rounded to ``want``."""
    return from_units(drop_places(F.sum(to_units(col, have)), have, want), want)


def mean_places(col: str, places: int) -> Column:
    """Mean of a column rounded to ``places``, rounded to the same."""
    unit = to_units(col, places)
    return from_units(divide_half_up(F.sum(unit), F.count(unit)), places)


def mean_over(col: str, places: int, window) -> Column:
    """Unrounded mean over a window of a column rounded to ``places``.

    The sum is taken in units, so that the mean of equal values is that very
    value, and none of them seems to lie below it.
    """
    unit = to_units(col, places)
    count = F.nullif(F.count(unit).over(window), F.lit(0).cast("long"))
    return from_units(F.sum(unit).over(window).cast("double") / count, places)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole of two longs, to two places."""
    return from_units(divide_half_up(part * F.lit(10_000).cast("long"), whole), 2)


def round_places(value: Column | str, places: int) -> Column:
    """Round a double half up at a decimal place.

    The value is first taken to ten places, which removes the noise of binary
    fractions, so that 85.2325 rounds as written and not as stored.
    """
    col = F.col(value) if isinstance(value, str) else value
    return F.round(col.cast("decimal(28,10)"), places).cast("double")

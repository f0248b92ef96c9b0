"""Division, rounding and clipping with the edge cases spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    value = ratio(part, whole) * F.lit(100.0)
    return value if digits is None else F.round(value, digits)


def clip(value: Column, *, lower: float | None = None, upper: float | None = None) -> Column:
    """Null stays null (``greatest``/``least`` alone would return the bound)."""
    bounded = value
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(value.isNotNull(), bounded)

"""Argument checks and schema-driven column selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every column that ``df`` lacks."""
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"columns not in the table: {absent}")


def numeric_columns(df: DataFrame, *, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, *, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns: both count as a missing cell."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null."""
    return F.when(~is_missing(df, name), F.col(f"`{name}`"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Fold NaN into null once, so later operators see one kind of missing."""
    return df.select(*[present(df, n).alias(n) for n in df.columns])

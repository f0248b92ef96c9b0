"""Sinks. Parquet by default, CSV by option, always written by the executors."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame


def write_table(df: DataFrame, folder: str, name: str, *, format: str = "parquet",
                partition_by: Iterable[str] = (), mode: str = "overwrite") -> str:
    """Write ``df`` to ``folder/name`` and return the path."""
    path = f"{str(folder).rstrip('/')}/{name}"
    writer = df.write.mode(mode).format(format)
    if format == "csv":
        writer = writer.option("header", True)
    columns = list(partition_by)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)
    return path


def file_slug(model_name: str) -> str:
    """Lower-case name with anything but letters, digits and ``_`` replaced."""
    return re.sub(r"[^a-z0-9_]+", "_", model_name.lower()).strip("_")


def write_top_features(importance: DataFrame, folder: str, *, model_name: str,
                       top_n: int = 20, format: str = "parquet") -> str:
    """The ``top_n`` most important features, in a table named after the model."""
    ranked = importance.orderBy(importance["importance"].desc(), importance["feature"]).limit(top_n)
    return write_table(ranked, folder, f"top_features_{file_slug(model_name)}", format=format)


def write_all(tables: dict[str, DataFrame], folder: str, *, format: str = "parquet") -> dict[str, str]:
    return {name: write_table(df, folder, name, format=format) for name, df in tables.items()}

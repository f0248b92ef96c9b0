"""Column naming, splitting, coercion and reshaping."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.checks import require_columns

_WHITESPACE = re.compile(r"\s+")

# The column order of a model comparison table.
COMPARISON_COLUMNS = (
    "model_name", "precision", "recall", "f1", "roc_auc", "pr_auc",
    "true_positives", "false_positives", "false_negatives", "true_negatives",
)


def snake_name(name: str) -> str:
    """Lower-case, no punctuation, inner whitespace runs as ``_`` (also where punctuation stood last)."""
    letters = "".join(ch for ch in name.strip().lower() if ch.isalnum() or ch == "_" or ch.isspace())
    return _WHITESPACE.sub("_", letters)


def snake_columns(df: DataFrame) -> DataFrame:
    names = [snake_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a name after renaming: {clashes}")
    return df.toDF(*names)


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(all other columns, the target column)."""
    require_columns(df, [target])
    return df.drop(target), df.select(target)


def coerce(df: DataFrame, types: dict[str, str | T.DataType]) -> DataFrame:
    """Cast the named columns that exist; what does not fit becomes null."""
    casts = {}
    for name, target in types.items():
        if name not in df.columns:
            continue
        source, column = df.schema[name].dataType, F.col(name)
        if str(target) in ("long", "bigint") and isinstance(source, T.StringType):
            # "25.0" is a whole number too.
            column = column.try_cast("double")
        casts[name] = column.try_cast(target)
    return df.withColumns(casts) if casts else df


def with_row_key(df: DataFrame, name: str = "transaction_id") -> DataFrame:
    """Add the md5 of all cells: unique wherever whole rows are, and the same on every run."""
    cells = [F.coalesce(F.concat(F.length(F.col(f"`{c}`").cast("string")).cast("string"), F.lit(":"), F.col(f"`{c}`").cast("string")), F.lit("~"))
             for c in df.columns if c != name]
    return df.withColumn(name, F.md5(F.concat_ws("|", *cells)))


def coerce_transactions(df: DataFrame) -> DataFrame:
    return coerce(df, {
        "purchase_value": "double", "age": "long", "ip_address": "double", "class": "long",
        "source": "string", "browser": "string", "sex": "string", "device_id": "string"})


def coerce_cards(df: DataFrame) -> DataFrame:
    types = {"time": "double", "amount": "double", "class": "long"}
    types.update({c: "double" for c in df.columns if c.startswith("v")})
    return coerce(df, types)


def coerce_ip_ranges(df: DataFrame) -> DataFrame:
    bounds = coerce(df, {"lower_bound_ip_address": "long", "upper_bound_ip_address": "long", "country": "string"})
    return bounds.withColumn("country", F.trim("country"))


def comparison_columns(df: DataFrame) -> DataFrame:
    """Known comparison columns in report order; ``auc_pr`` is accepted for ``pr_auc``."""
    if "pr_auc" not in df.columns and "auc_pr" in df.columns:
        df = df.withColumnRenamed("auc_pr", "pr_auc")
    return df.select(*[c for c in COMPARISON_COLUMNS if c in df.columns])


def metrics_long(df: DataFrame, metrics: Sequence[str], *, id_column: str = "model_name") -> DataFrame:
    """One row per model and metric."""
    require_columns(df, [id_column, *metrics])
    return df.unpivot(id_column, list(metrics), "metric", "score")


def stack_rows(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are null there."""
    tables = list(frames)
    if not tables:
        raise ValueError("nothing to stack")
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    return stacked

"""Table profiles: describe, missing cells, duplicates, class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.functions.checks import is_missing, numeric_columns, present, require_columns, string_columns
from txnlens.functions.numbers import percent
from txnlens.operators.columns import stack_rows
from txnlens.operators.quantiles import quantile_frame

_QUARTILES = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))


def _dtype(df: DataFrame, name: str) -> Column:
    return F.lit(df.schema[name].dataType.simpleString())


def _one_row_per_column(wide: DataFrame, columns: Sequence[str], fields: dict) -> DataFrame:
    """Turn a one-row aggregate into a row per column; ``fields`` maps name -> column maker."""
    cells = [F.struct(F.lit(c).alias("column"), *[make(i, c).alias(n) for n, make in fields.items()])
             for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*cells)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null values of several columns as text: (``column``, ``value``, ``n``).

    Counting before anything else lets a frequent value combine inside the map tasks.
    """
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), present(df, c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(cells)).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )


def most_common(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: number of values, of distinct values, the most frequent one (ties: smallest)."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").alias("value")))
    return (
        value_counts(df, columns).groupBy("column")
        .agg(F.sum("n").alias("count"), F.count("*").alias("unique"), best.alias("best"))
        .select("column", "count", "unique", F.col("best.value").alias("top"), (-F.col("best.rank")).alias("freq"))
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, *, digits: int | None = None,
                     approx: int | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles, max, dtype and missing cells per numeric column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    require_columns(df, names)
    if not names:
        raise ValueError("no numeric columns")
    aggregates = []
    for i, c in enumerate(names):
        value = present(df, c).cast("double")
        aggregates += [F.count(value).alias(f"count{i}"), F.avg(value).alias(f"mean{i}"),
                       F.stddev_samp(value).alias(f"std{i}"), F.min(value).alias(f"min{i}"),
                       F.max(value).alias(f"max{i}"), F.count_if(is_missing(df, c)).alias(f"missing{i}")]

    def field(stat: str):
        return lambda i, c: F.col(f"{stat}{i}")

    stats = _one_row_per_column(df.agg(*aggregates), names, {
        **{s: field(s) for s in ("count", "mean", "std", "min", "max", "missing")},
        "dtype": lambda i, c: _dtype(df, c)})
    quartiles = quantile_frame(df, names, [p for p, _ in _QUARTILES], approx=approx).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in _QUARTILES])
    table = stats.join(quartiles, "column").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max", "dtype", "missing")
    if digits is not None:
        table = table.withColumns({c: F.round(c, digits) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})
    return table


def describe_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """dtype, count, missing, unique, top and freq per text column."""
    names = list(columns) if columns is not None else string_columns(df)
    require_columns(df, names)
    if not names:
        raise ValueError("no text columns")
    gaps = _one_row_per_column(
        df.agg(*[F.count_if(is_missing(df, c)).alias(f"missing{i}") for i, c in enumerate(names)]), names,
        {"missing": lambda i, c: F.col(f"missing{i}"), "dtype": lambda i, c: _dtype(df, c)})
    return gaps.join(most_common(df, names), "column", "left").select(
        "column", "dtype", F.coalesce("count", F.lit(0)).alias("count"), "missing",
        F.coalesce("unique", F.lit(0)).alias("unique"), "top", F.coalesce("freq", F.lit(0)).alias("freq"))


def describe(df: DataFrame, *, include_strings: bool = True, approx: int | None = None) -> DataFrame:
    """Numeric and text profiles in one table; what a kind lacks is null."""
    parts = []
    if numeric_columns(df):
        parts.append(describe_numeric(df, approx=approx))
    if include_strings and string_columns(df):
        parts.append(describe_strings(df))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string")
    return stack_rows(parts)


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing cells per column, most first."""
    names = df.columns
    wide = df.agg(F.count("*").alias("rows"),
                  *[F.count_if(is_missing(df, c)).alias(f"missing{i}") for i, c in enumerate(names)])
    return _one_row_per_column(wide, names, {
        "missing_count": lambda i, c: F.col(f"missing{i}"),
        "missing_pct": lambda i, c: percent(F.col(f"missing{i}"), F.col("rows"), 2),
        "dtype": lambda i, c: _dtype(df, c),
    }).orderBy(F.col("missing_count").desc(), "column")


def column_overview(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """dtype, non-null and missing cells and distinct values per column."""
    names = df.columns
    aggregates = [F.count("*").alias("rows"),
                  *[F.count_if(is_missing(df, c)).alias(f"missing{i}") for i, c in enumerate(names)]]
    if approx:
        aggregates += [F.approx_count_distinct(present(df, c)).alias(f"unique{i}") for i, c in enumerate(names)]
    fields = {
        "dtype": lambda i, c: _dtype(df, c),
        "non_null": lambda i, c: F.col("rows") - F.col(f"missing{i}"),
        "missing": lambda i, c: F.col(f"missing{i}"),
        "missing_pct": lambda i, c: percent(F.col(f"missing{i}"), F.col("rows"), 2),
    }
    if approx:
        return _one_row_per_column(df.agg(*aggregates), names,
                                   {**fields, "unique": lambda i, c: F.col(f"unique{i}")})
    distinct = value_counts(df, names).groupBy("column").agg(F.count("*").alias("unique"))
    return _one_row_per_column(df.agg(*aggregates), names, fields).join(distinct, "column", "left").withColumn(
        "unique", F.coalesce("unique", F.lit(0)))


def column_profile(df: DataFrame) -> DataFrame:
    """Name, dtype and share of non-null cells per column."""
    names = df.columns
    wide = df.agg(F.count("*").alias("rows"),
                  *[F.count_if(~is_missing(df, c)).alias(f"known{i}") for i, c in enumerate(names)])
    return _one_row_per_column(wide, names, {
        "dtype": lambda i, c: _dtype(df, c),
        "non_null_pct": lambda i, c: percent(F.col(f"known{i}"), F.col("rows"), 1)})


def duplicate_check(df: DataFrame, *, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: rows in duplicate groups, rows a dedup would remove, their share in percent."""
    keys = list(subset) if subset else df.columns
    require_columns(df, keys)
    copies = F.col("n")
    return (
        df.groupBy(*keys).agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.when(copies > 1, copies)), F.lit(0)).alias("rows_in_duplicate_groups"),
             F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicate_rows_to_remove"),
             F.coalesce(F.sum(copies), F.lit(0)).alias("rows"))
        .select("rows_in_duplicate_groups", "duplicate_rows_to_remove",
                F.coalesce(percent(F.col("duplicate_rows_to_remove"), F.col("rows"), 4), F.lit(0.0))
                .alias("duplicate_pct"))
    )


def class_balance(df: DataFrame, target: str = "class", *, stage: str | None = None) -> DataFrame:
    """Rows per class (null included), share in percent, and the largest-to-smallest ratio."""
    require_columns(df, [target])
    staged = df.withColumn("stage", F.lit(stage or "all"))
    table = balance_by_stage(staged, target=target)
    return table if stage else table.drop("stage")


def balance_by_stage(df: DataFrame, *, target: str = "class", stage_column: str = "stage") -> DataFrame:
    """``class_balance`` for every stage in one aggregation."""
    require_columns(df, [target, stage_column])
    counts = df.groupBy(F.col(stage_column).alias("stage"), F.col(target).alias("class")).agg(F.count("*").alias("count"))
    # From here on there is one row per stage and class.
    totals = counts.groupBy("stage").agg(
        F.sum("count").alias("_all"), F.max("count").alias("_most"), F.min("count").alias("_least"),
        F.count("*").alias("_classes"))
    spread = F.when(F.col("_classes") >= 2, F.round(F.col("_most") / F.col("_least"), 4))
    return counts.join(totals, "stage").select(
        "stage", "class", "count", percent(F.col("count"), F.col("_all"), 4).alias("pct"),
        spread.alias("imbalance_ratio"))


def stage_balance(comparison: DataFrame, stage: str) -> DataFrame:
    """The rows of one stage of a balance table, by class."""
    require_columns(comparison, ["stage", "class"])
    return comparison.where(F.col("stage") == stage).drop("stage").orderBy("class")


def compare_stages(stages: dict[str, DataFrame], *, target: str = "class") -> DataFrame:
    """Class balance of several tables, e.g. before and after resampling."""
    tagged = [df.select(F.lit(name).alias("stage"), F.col(target).alias("class")) for name, df in stages.items()]
    return balance_by_stage(stack_rows(tagged), target="class")

"""Missing values, duplicates and timestamps."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.checks import is_missing, numeric_columns, require_columns, string_columns
from txnlens.functions.clock import TIME_FORMAT, parse_time
from txnlens.operators.profiling import most_common
from txnlens.operators.quantiles import quantile_values

NUMERIC_FILLS = ("median", "mean", "zero")
STRING_FILLS = ("mode", "unknown")


def drop_missing(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Rows that have every required column."""
    columns = list(required)
    require_columns(df, columns)
    return df.dropna(subset=columns) if columns else df


def fill_values(df: DataFrame, *, numeric_fill: str = "median", string_fill: str = "mode",
                exclude: Iterable[str] = (), approx: int | None = None) -> dict[str, float | str]:
    """The fill value of every column that has a missing cell: one number or text each."""
    if numeric_fill not in NUMERIC_FILLS:
        raise ValueError(f"numeric_fill must be one of {NUMERIC_FILLS}")
    if string_fill not in STRING_FILLS:
        raise ValueError(f"string_fill must be one of {STRING_FILLS}")
    candidates = numeric_columns(df, exclude=exclude) + string_columns(df, exclude=exclude)
    if not candidates:
        return {}
    seen = df.agg(F.count("*").alias("_rows"), *[F.count_if(is_missing(df, c)).alias(c) for c in candidates]).first()
    gaps = [c for c in candidates if seen[c]]
    numbers = [c for c in numeric_columns(df) if c in gaps]
    texts = [c for c in string_columns(df) if c in gaps]
    fills: dict[str, float | str] = {}
    if numeric_fill == "zero":
        fills.update({c: 0.0 for c in numbers})
    elif numeric_fill == "mean" and numbers:
        means = df.agg(*[F.avg(F.when(~is_missing(df, c), F.col(c).cast("double"))).alias(c) for c in numbers]).first()
        fills.update({c: means[c] for c in numbers})
    elif numbers:
        fills.update({c: v[0] for c, v in quantile_values(
            df, numbers, [0.5], approx=approx, rows=seen["_rows"]).items()})
    if string_fill == "mode" and texts:
        tops = {r["column"]: r["top"] for r in most_common(df, texts).collect()}
        fills.update({c: tops.get(c) or "unknown" for c in texts})
    else:
        fills.update({c: "unknown" for c in texts})
    return {c: v for c, v in fills.items() if v is not None}


def apply_fills(df: DataFrame, fills: dict[str, float | str]) -> DataFrame:
    """Replace missing cells. A whole-number column turns to double only for a fractional fill."""
    filled = {}
    for name, value in fills.items():
        column, data_type = F.col(name), df.schema[name].dataType
        literal = F.lit(value)
        if isinstance(data_type, T.IntegralType):
            if float(value).is_integer():
                literal = F.lit(int(value)).cast(data_type)
            else:
                column = column.cast("double")
        filled[name] = F.when(is_missing(df, name), literal).otherwise(column)
    return df.withColumns(filled) if filled else df


def fill_missing(df: DataFrame, *, required: Iterable[str] = (), numeric_fill: str = "median",
                 string_fill: str = "mode", exclude: Iterable[str] = (),
                 approx: int | None = None) -> DataFrame:
    """Drop rows without a required value, then fill numbers and texts. Times are never filled.

    Fill values come from the rows that are left. ``exclude`` keeps identifiers as they are.
    """
    kept = drop_missing(df, required)
    return apply_fills(kept, fill_values(kept, numeric_fill=numeric_fill, string_fill=string_fill,
                                         exclude=exclude, approx=approx))


def drop_duplicates(df: DataFrame, *, subset: Sequence[str] | None = None,
                    keep: str | bool = "first", order_by: Sequence[str] = ()) -> DataFrame:
    """Remove duplicate rows; null equals null.

    ``keep`` is ``"first"``/``"last"`` by ``order_by`` or False to drop every copy. None of the
    forms gathers a group of copies in one task: whole-row duplicates and counts combine before
    the shuffle, and ``row_number() = 1`` is limited per map task before it.
    """
    if keep not in ("first", "last", False):
        raise ValueError('keep must be "first", "last" or False')
    keys = list(subset) if subset else df.columns
    require_columns(df, [*keys, *order_by])
    if keep is False:
        whole_row = F.struct(*[F.col(c) for c in df.columns])
        return (
            df.groupBy(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(keys)])
            .agg(F.count("*").alias("_copies"), F.first(whole_row).alias("_row"))
            .where(F.col("_copies") == 1).select("_row.*")
        )
    if set(keys) == set(df.columns):
        return df.dropDuplicates()
    if not order_by:
        raise ValueError("keeping the first or last row of a subset needs order_by")
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order_by]
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")


def parse_timestamps(df: DataFrame, columns: Iterable[str], *, fmt: str = TIME_FORMAT,
                     errors: str = "coerce") -> DataFrame:
    """Text columns to TIMESTAMP_NTZ. Bad text is null, or fails the query with ``errors="raise"``."""
    names = list(columns)
    require_columns(df, names)
    if errors not in ("coerce", "raise"):
        raise ValueError('errors must be "coerce" or "raise"')
    parsed = {}
    for name in names:
        if not isinstance(df.schema[name].dataType, T.StringType):
            parsed[name] = F.col(name).cast("timestamp_ntz")
            continue
        moment = parse_time(F.col(name), fmt)
        if errors == "raise":
            bad = F.col(name).isNotNull() & moment.isNull()
            message = F.concat(F.lit(f"{name} is not a time: "), F.col(name))
            moment = F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(moment)
        parsed[name] = moment
    return df.withColumns(parsed)


def unparsed_counts(df: DataFrame, columns: Iterable[str], *, fmt: str = TIME_FORMAT) -> DataFrame:
    """How many non-null texts per column do not parse: (``column``, ``invalid``)."""
    names = list(columns)
    require_columns(df, names)
    wide = df.agg(*[
        F.count_if(F.col(c).isNotNull() & parse_time(F.col(c).cast("string"), fmt).isNull()).alias(c) for c in names])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("invalid")) for c in names])))

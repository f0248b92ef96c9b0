"""Scaled and one-hot encoded feature matrices.

:func:`fit_encoder` is for columns of few categories: it names every column of the matrix, refuses more than
``MOST_COLUMNS`` and applies as a projection without shuffle or UDF. :func:`fit_sparse_encoder` is for any number of
categories, identifiers included: the categories stay a table, numbered in order by running counts over a range
partition, and reach the rows by joins; zeros are never made.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.checks import present, require_columns
from txnlens.operators.profiling import value_counts
from txnlens.operators.running import running_sums
from txnlens.session import materialize

# The feature columns a fraud model uses, in matrix order.
NUMERIC_FEATURES = (
    "purchase_value", "age", "time_since_signup_hours", "hour_of_day", "day_of_week",
    "txn_count_last_1h", "txn_count_last_24h", "txn_count_last_168h",
    "hours_since_last_txn", "user_cumulative_txn_count", "user_txn_velocity_per_day",
)
CATEGORICAL_FEATURES = ("source", "browser", "sex")
OPTIONAL_CATEGORICAL_FEATURES = ("country",)

#: Most categories of a matrix whose columns have names.
MOST_COLUMNS = 10_000
#: Up to so many categories of a column are broadcast; about 20 MB.
BROADCAST_CATEGORIES = 200_000
#: A category with so many rows, or one in so many of all rows, does not go through a shuffle.
HOT_ROWS = 1_000_000
HOT_SHARE = 100_000
_SPREAD = 4096


@dataclass(frozen=True)
class FeatureConfig:
    numeric: tuple[str, ...] = NUMERIC_FEATURES
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES
    optional_categorical: tuple[str, ...] = OPTIONAL_CATEGORICAL_FEATURES
    target: str = "class"

    def resolve(self, available: Sequence[str]) -> tuple[list[str], list[str]]:
        """(numeric, categorical) columns that exist; either list empty is an error."""
        numeric = [c for c in self.numeric if c in available]
        categorical = [c for c in (*self.categorical, *self.optional_categorical) if c in available]
        if not numeric:
            raise ValueError("none of the numeric features is available")
        if not categorical:
            raise ValueError("none of the categorical features is available")
        return numeric, categorical


@dataclass(frozen=True)
class FittedEncoder:
    """Means, deviations and categories learned from one table."""

    scales: dict[str, tuple[float, float]]
    categories: dict[str, list[str]]
    target: str = "class"
    names: list[str] = field(init=False)

    def __post_init__(self) -> None:
        names = list(self.scales) + [f"{c}_{v}" for c, values in self.categories.items() for v in values]
        object.__setattr__(self, "names", names)

    def columns(self) -> list[Column]:
        """Matrix columns in order: scaled numbers, then one 0/1 column per category."""
        scaled = [((F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation)).alias(c)
                  for c, (mean, deviation) in self.scales.items()]
        flags = [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{v}")
                 for c, values in self.categories.items() for v in values]
        return scaled + flags

    def _kept(self, df: DataFrame, keep: Sequence[str]) -> list[Column]:
        require_columns(df, [*self.scales, *self.categories, *keep])
        kept = [F.col(c) for c in keep]
        if self.target in df.columns and self.target not in keep:
            kept.append(F.col(self.target).cast("long").alias(self.target))
        return kept

    def wide(self, df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
        """One column per feature. Unseen categories are all zeros, other columns are dropped."""
        return df.select(*self._kept(df, keep), *self.columns())

    def vectors(self, df: DataFrame, *, keep: Sequence[str] = (), output_column: str = "features") -> DataFrame:
        """The matrix as one vector column."""
        return df.select(*self._kept(df, keep), array_to_vector(F.array(*self.columns())).alias(output_column))

    def long(self, df: DataFrame, *, keep: Sequence[str]) -> DataFrame:
        """(``keep``, ``feature``, ``value``) rows."""
        require_columns(df, [*self.scales, *self.categories, *keep])
        # An array of plain numbers keeps the generated code small; names join by position.
        cells = df.select(*keep, F.posexplode(F.array(*self.columns())).alias("_position", "value"))
        names = F.array(*[F.lit(n) for n in self.names])
        return cells.select(*keep, F.get(names, F.col("_position")).alias("feature"), "value")

    def feature_table(self, df: DataFrame) -> DataFrame:
        """Feature names with their position in the matrix."""
        return df.sparkSession.createDataFrame(list(enumerate(self.names)), "position int, feature string")


def _scales(df: DataFrame, numeric: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Population mean and deviation (1 for a constant column) of the cells that are there."""
    values = [present(df, c).cast("double") for c in numeric]
    moments = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
                     *[F.stddev_pop(v).alias(f"d{i}") for i, v in enumerate(values)]).first()
    return {c: (moments[f"m{i}"] or 0.0, moments[f"d{i}"] or 1.0) for i, c in enumerate(numeric)}


def fit_encoder(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> FittedEncoder:
    """Scales of the numbers, and the categories in text order; more than ``MOST_COLUMNS`` are an error."""
    numeric, categorical = config.resolve(df.columns)
    seen = value_counts(df, categorical).select("column", "value").limit(MOST_COLUMNS + 1).collect()
    if len(seen) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} categories: use fit_sparse_encoder")
    categories = {c: sorted(r["value"] for r in seen if r["column"] == c) for c in categorical}
    return FittedEncoder(_scales(df, numeric), categories, config.target)


@dataclass(frozen=True)
class SparseEncoder:
    """Scales, and a written table of categories: ``column, value, rows, position`` (from the number of scales up)."""

    scales: dict[str, tuple[float, float]]
    vocabulary: DataFrame
    #: Categories and rows of each text column, in the order of their positions.
    sizes: dict[str, tuple[int, int]]
    target: str = "class"

    @property
    def width(self) -> int:
        return len(self.scales) + sum(n for n, _ in self.sizes.values())

    def _positions(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the position of its value in ``column``, null where the value is missing or unknown."""
        out = f"__at_{column}"
        categories, rows = self.sizes[column]
        table = self.vocabulary.where(F.col("column") == column).select(F.col("value").alias("__value"), F.col("position").alias(out), "rows")
        keyed = df.withColumn("__value", F.col(column).cast("string"))
        if categories <= BROADCAST_CATEGORIES:
            return keyed.join(F.broadcast(table.drop("rows")), "__value", "left").drop("__value")
        # At most HOT_SHARE categories have a 1/HOT_SHARE of the rows.
        hot = F.col("rows") >= max(HOT_ROWS, rows // HOT_SHARE)
        found = keyed.join(F.broadcast(table.where(hot).select("__value", F.col(out).alias("__hot"))), "__value", "left")
        # Rows that are settled, or have nothing to look up, are dealt by a hash of the row.
        settled = F.col("__hot").isNotNull() | F.col("__value").isNull()
        spread = F.when(settled, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(_SPREAD)) + 1).otherwise(0)
        rest = table.where(~hot).select(F.col("__value"), F.lit(0).cast("long").alias("__spread"), out)
        looked_up = found.withColumn("__spread", spread).withColumn("__value", F.when(~settled, F.col("__value")))
        joined = looked_up.join(rest, ["__value", "__spread"], "left")
        return joined.withColumn(out, F.coalesce("__hot", out)).drop("__value", "__spread", "__hot")

    def cells(self, df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
        """``keep``, the target if it is there, and ``indices`` and ``values`` of the cells that are not zero.

        A missing number has no cell, which reads as the mean; so have missing and unknown categories.
        """
        require_columns(df, [*self.scales, *self.sizes, *keep])
        kept = [*keep, *([self.target] if self.target in df.columns and self.target not in keep else [])]
        number = [F.struct(F.lit(i).alias("i"), ((F.col(c).cast("double") - F.lit(m)) / F.lit(d)).alias("v"))
                  for i, (c, (m, d)) in enumerate(self.scales.items())]
        found = df.select(*kept, F.array(*number).alias("__numbers"), *[F.col(c) for c in self.sizes if c not in kept])
        for column in self.sizes:
            found = self._positions(found, column)
        flags = [F.struct(F.col(f"__at_{c}").alias("i"), F.lit(1.0).alias("v")) for c in self.sizes]
        cells = F.filter(F.concat("__numbers", F.array(*flags)), lambda x: x["i"].isNotNull() & x["v"].isNotNull() & (x["v"] != 0))
        return found.select(*kept, cells.alias("__cells")).select(
            *kept, F.transform("__cells", lambda x: x["i"]).alias("indices"), F.transform("__cells", lambda x: x["v"]).alias("values"))

    def long(self, df: DataFrame, *, keep: Sequence[str]) -> DataFrame:
        """(``keep``, ``position``, ``value``) of the cells that are not zero."""
        return self.cells(df, keep=keep).select(*keep, F.inline(F.arrays_zip(F.col("indices").alias("position"), F.col("values").alias("value"))))

    def vectors(self, df: DataFrame, *, keep: Sequence[str] = (), output_column: str = "features") -> DataFrame:
        """The matrix as one column of sparse vectors, in a written table.

        A sparse vector is stored as a structure; written as such and read with the vector type it needs no UDF.
        """
        cells = self.cells(df, keep=keep)
        stored = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(self.width).alias("size"), "indices", "values")
        flat = cells.select(*[c for c in cells.columns if c not in ("indices", "values")], stored.alias(output_column))
        typed = T.StructType([*flat.schema.fields[:-1], T.StructField(output_column, VectorUDT())])
        return materialize(flat, "sparse", read_as=typed)

    def feature_table(self) -> DataFrame:
        """Feature names with their position in the matrix."""
        spark = self.vocabulary.sparkSession
        numbers = spark.createDataFrame(list(enumerate(self.scales)), "position int, feature string")
        return numbers.unionByName(self.vocabulary.select("position", F.concat_ws("_", "column", "value").alias("feature")))


def fit_sparse_encoder(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> SparseEncoder:
    """As :func:`fit_encoder`, for any number of categories; none of them passes through the driver."""
    numeric, categorical = config.resolve(df.columns)
    cell = [F.struct(F.lit(i).alias("rank"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(categorical)]
    seen = materialize(df.select(F.inline(F.array(*cell))).where(F.col("value").isNotNull()).groupBy("rank", "column", "value").agg(
        F.count("*").alias("rows")), "categories")
    sizes = {r["column"]: (r["n"], r["m"]) for r in seen.groupBy("rank", "column").agg(
        F.count("*").alias("n"), F.sum("rows").alias("m")).orderBy("rank").collect()}
    if len(numeric) + sum(n for n, _ in sizes.values()) >= 2 ** 31:
        raise ValueError("a matrix has fewer than 2^31 columns")
    placed = running_sums(seen.withColumn("__all", F.lit(0)), ["__all"], ["rank", "value"], {"place": F.lit(1).cast("long")},
                          n_rows=sum(n for n, _ in sizes.values()), label="category-order")
    vocabulary = materialize(placed.select("column", "value", "rows", (F.col("place") - 1 + len(numeric)).cast("int").alias("position")),
                             "vocabulary")
    return SparseEncoder(_scales(df, numeric), vocabulary, {c: sizes[c] for c in categorical if c in sizes}, config.target)

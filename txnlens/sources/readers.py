"""Typed readers for the raw tables and for saved results.

Schemas are explicit: no inference pass, no count on load. Text that does not fit a type
becomes null (CSV permissive mode), and times stay text until they are parsed on purpose.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from txnlens.functions.checks import require_columns

# File names and column layouts of the three raw tables.
TRANSACTIONS_FILE = "Fraud_Data.csv"
CARDS_FILE = "creditcard.csv"
IP_RANGES_FILE = "IpAddress_to_Country.csv"

TRANSACTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("signup_time", T.StringType()),
    T.StructField("purchase_time", T.StringType()),
    T.StructField("purchase_value", T.DoubleType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("age", T.LongType()),
    T.StructField("ip_address", T.DoubleType()),
    T.StructField("class", T.LongType()),
])
CARDS = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(f"V{i}", T.DoubleType()) for i in range(1, 29)]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.LongType())]
)
IP_RANGES = T.StructType([
    T.StructField("lower_bound_ip_address", T.DoubleType()),
    T.StructField("upper_bound_ip_address", T.DoubleType()),
    T.StructField("country", T.StringType()),
])

_SUFFIXES = (".parquet", ".orc", ".json", ".csv")


def _join(folder: str, name: str) -> str:
    return f"{str(folder).rstrip('/')}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is readable on whatever file system it names."""
    try:
        spark.read.format("binaryFile").option("pathGlobFilter", "*").load(path).schema
    except AnalysisException:
        return False
    return True


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *,
             header: bool = True, **options: str) -> DataFrame:
    """Headered CSV scan; ``FileNotFoundError`` when nothing is there."""
    try:
        return spark.read.schema(schema).options(header=header, **options).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise


def read_transactions(spark: SparkSession, folder: str, *, ip_as_text: bool = False) -> DataFrame:
    """``ip_as_text`` keeps the address column raw, so dotted quads survive."""
    schema = TRANSACTIONS
    if ip_as_text:
        schema = T.StructType([
            T.StructField(f.name, T.StringType()) if f.name == "ip_address" else f for f in schema
        ])
    return read_csv(spark, _join(folder, TRANSACTIONS_FILE), schema)


def read_cards(spark: SparkSession, folder: str) -> DataFrame:
    return read_csv(spark, _join(folder, CARDS_FILE), CARDS)


def read_ip_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return read_csv(spark, _join(folder, IP_RANGES_FILE), IP_RANGES)


def read_table(spark: SparkSession, path: str, *, format: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Read a saved result; the format follows the suffix unless given."""
    suffix = PurePosixPath(path).suffix
    chosen = format or (suffix.lstrip(".") if suffix in _SUFFIXES else "parquet")
    reader = spark.read.format(chosen)
    if chosen == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise


def read_optional(spark: SparkSession, path: str, **kwargs) -> DataFrame | None:
    """``read_table`` that answers None when the table is absent."""
    try:
        return read_table(spark, path, **kwargs)
    except FileNotFoundError:
        return None


def first_existing(spark: SparkSession, folders: Iterable[str], table: str) -> str:
    """The first folder that holds ``table``, else the first folder."""
    candidates = list(folders)
    for folder in candidates:
        if path_exists(spark, _join(folder, table)):
            return folder
    return candidates[0]


def read_result_tables(spark: SparkSession, folders: Iterable[str],
                       tables: Iterable[str]) -> dict[str, DataFrame]:
    """Several result tables from the first folder that has the first of them."""
    names = list(tables)
    folder = first_existing(spark, folders, names[0])
    return {name: read_table(spark, _join(folder, name)) for name in names}


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], *,
                  required: Iterable[str] = ()) -> DataFrame:
    """Read a saved table, or build it when it is absent; check its columns either way."""
    saved = read_optional(spark, path)
    table = build() if saved is None else saved
    require_columns(table, required)
    return table

"""Raw tables to cleaned, geolocated and engineered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlens.functions.checks import require_columns
from txnlens.operators.cleaning import drop_duplicates, fill_missing, parse_timestamps
from txnlens.operators.columns import coerce_cards, coerce_ip_ranges, coerce_transactions, snake_columns, with_row_key
from txnlens.operators.encoding import FeatureConfig, FittedEncoder, fit_encoder
from txnlens.operators.geolocation import LOWER, UPPER, add_ip_integer, attach_country
from txnlens.operators.segments import rate_by
from txnlens.operators.temporal import add_purchase_clock, add_time_since_signup
from txnlens.operators.velocity import add_velocity
from txnlens.session import materialize
from txnlens.sources import readers
from txnlens.sources.writers import write_all, write_table

# Identifiers and addresses: a median of these means nothing.
IDENTIFIERS = ("user_id", "event_id", "ip_address")
TIMES = ("signup_time", "purchase_time")


# The raw table has no key: users repeat, so rows are known by all their cells.
ROW_KEY = "transaction_id"


def clean_transactions(raw: DataFrame, *, fill_identifiers: bool = False, approx: int | None = None,
                       row_key: str | None = None) -> DataFrame:
    """Names, times, whole-row duplicates, missing values, types.

    Identifiers keep their gaps unless ``fill_identifiers``. Ages filled with a fractional
    median are cut to whole years by the final types. The deduplicated rows are written to the
    shared folder: finding the fill values then scans single columns instead of repeating the
    whole-row shuffle. ``row_key`` names a column that gets a digest of the distinct row.
    """
    table = drop_duplicates(parse_timestamps(snake_columns(raw), TIMES))
    table = materialize(with_row_key(table, row_key) if row_key else table, "deduplicated")
    table = fill_missing(table, required=[*TIMES, "class"], numeric_fill="median", string_fill="unknown",
                         exclude=() if fill_identifiers else IDENTIFIERS, approx=approx)
    return coerce_transactions(table)


def clean_cards(raw: DataFrame, *, approx: int | None = None) -> DataFrame:
    """Names, whole-row duplicates, median and mode fills, types."""
    table = materialize(drop_duplicates(snake_columns(raw)), "deduplicated")
    return coerce_cards(fill_missing(table, numeric_fill="median", string_fill="mode", approx=approx))


def clean_ip_ranges(raw: DataFrame) -> DataFrame:
    """Names, no missing cell, one row per pair of bounds, types, trimmed country.

    Incomplete rows go first, so that they never stand in for a complete row of the same bounds.
    """
    table = fill_missing(snake_columns(raw), required=[LOWER, UPPER, "country"], string_fill="unknown")
    return coerce_ip_ranges(drop_duplicates(table, subset=[LOWER, UPPER], keep="first", order_by=["country"]))


def cleaning_job(spark: SparkSession, raw_folder: str, output_folder: str, *, format: str = "parquet") -> dict[str, str]:
    """Write the three cleaned tables."""
    return write_all({
        "fraud_data_cleaned": clean_transactions(readers.read_transactions(spark, raw_folder)),
        "creditcard_cleaned": clean_cards(readers.read_cards(spark, raw_folder)),
        "ip_country_cleaned": clean_ip_ranges(readers.read_ip_ranges(spark, raw_folder)),
    }, output_folder, format=format)


def geolocate(transactions: DataFrame, ip_ranges: DataFrame, **lookup) -> DataFrame:
    """Cleaned transactions with ``ip_address_int`` and ``country``."""
    return add_ip_integer(transactions).transform(attach_country, ip_ranges, **lookup)


def geolocation_job(spark: SparkSession, raw_folder: str, output_folder: str, *, min_transactions: int = 100,
                    format: str = "parquet") -> tuple[DataFrame, DataFrame, str]:
    """Clean, look up countries, write; returns the written table, country rates and the path."""
    enriched = geolocate(clean_transactions(readers.read_transactions(spark, raw_folder)),
                         clean_ip_ranges(readers.read_ip_ranges(spark, raw_folder)))
    path = write_table(enriched, output_folder, "fraud_data_geolocated", format=format)
    saved = readers.read_table(spark, path, format=format, schema=enriched.schema)
    return saved, rate_by(saved, "country", min_transactions=min_transactions), path


def load_base(spark: SparkSession, raw_folder: str, *, include_country: bool = True) -> DataFrame:
    """Cleaned transactions with ``transaction_id``, and with countries when the range table exists."""
    return with_country(clean_transactions(readers.read_transactions(spark, raw_folder), row_key=ROW_KEY), raw_folder,
                        include_country=include_country)


def with_country(cleaned: DataFrame, raw_folder: str, *, include_country: bool = True) -> DataFrame:
    """Countries from the raw range table, or the table as it is when there is none."""
    if not include_country:
        return cleaned
    try:
        ranges = readers.read_ip_ranges(cleaned.sparkSession, raw_folder)
    except FileNotFoundError:
        return cleaned
    return geolocate(cleaned, clean_ip_ranges(ranges))


def engineer(table: DataFrame, *, order_key: str = "event_id", as_of_row: bool = False,
             history: DataFrame | None = None, **velocity) -> DataFrame:
    """Time-since-signup, clock and velocity columns.

    ``history`` holds earlier transactions of the same users: velocity sees them, the result
    does not contain them.
    """
    require_columns(table, [order_key])
    if history is not None:
        tagged = table.selectExpr("*", "false AS _past").unionByName(history.selectExpr("*", "true AS _past"))
        return engineer(tagged, order_key=order_key, as_of_row=as_of_row, **velocity).where("NOT _past").drop("_past")
    timed = add_purchase_clock(add_time_since_signup(table))
    return add_velocity(timed, order_key=order_key, as_of_row=as_of_row, **velocity)


def feature_matrix(engineered: DataFrame, *, config: FeatureConfig = FeatureConfig(), fit_on: DataFrame | None = None,
                   keep: tuple[str, ...] = ("event_id",)) -> tuple[DataFrame, FittedEncoder]:
    """The encoded matrix and its encoder. ``fit_on`` defaults to all rows; pass the train rows
    to keep the holdout out of the fit."""
    require_columns(engineered, [config.target])
    encoder = fit_encoder(engineered if fit_on is None else fit_on, config)
    return encoder.wide(engineered, keep=keep), encoder


def feature_job(spark: SparkSession, raw_folder: str, output_folder: str, *, include_country: bool = True,
                order_key: str = ROW_KEY, keep_key: bool = False, format: str = "parquet") -> dict[str, str]:
    """Write the engineered table (with the row key if wanted), then the matrix built from the written table."""
    cleaned = clean_transactions(readers.read_transactions(spark, raw_folder), row_key=ROW_KEY)
    engineered = engineer(with_country(cleaned, raw_folder, include_country=include_country), order_key=order_key,
                          count_users_in=cleaned)
    engineered = engineered if keep_key else engineered.drop(ROW_KEY)
    engineered_path = write_table(engineered, output_folder, "fraud_data_engineered", format=format)
    saved = readers.read_table(spark, engineered_path, format=format, schema=engineered.schema)
    matrix, _ = feature_matrix(saved, keep=())
    return {"engineered": engineered_path,
            "features": write_table(matrix, output_folder, "fraud_data_features", format=format)}

"""Transaction-shaped tables derived from the given star-schema tables.

The raw transaction files are not shipped, so each of these views reads whole given
tables and reshapes them. They grow with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The arithmetic that turns a row id into an address, and the two key lists.
IP_MULTIPLIER = 2_654_435_761
IP_SPACE = 4_294_967_296
SOURCES = ("SEO", "Ads", "Direct")
BROWSERS = ("Chrome", "IE", "Safari", "FireFox", "Opera")
RANGE_STEP = 171_798_691
RANGE_WIDTH = 150_000_000


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _nth(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per event; a user signs up at their first event."""
    events = given(spark, folder, "events")
    signup = events.groupBy("user_id").agg(F.min("ts").alias("signup_time"))
    event_id = F.col("event_id")
    return events.join(signup, "user_id").select(
        "event_id", "user_id", "signup_time",
        F.col("ts").alias("purchase_time"),
        F.col("value").alias("purchase_value"),
        F.concat(F.lit("D"), (event_id % 97).cast("string")).alias("device_id"),
        _nth(SOURCES, event_id % 3).alias("source"),
        _nth(BROWSERS, event_id * 7 % 5).alias("browser"),
        F.when(F.col("user_id") % 2 == 0, "M").otherwise("F").alias("sex"),
        (F.lit(18) + F.col("user_id") % 50).cast("long").alias("age"),
        ((event_id * IP_MULTIPLIER % IP_SPACE).cast("double") + F.lit(0.25)).alias("ip_address"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).cast("int").alias("class"),
    )


def ip_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """One address range per nation, with gaps between them."""
    lower = F.col("n_nationkey").cast("long") * RANGE_STEP
    return given(spark, folder, "nation").select(
        lower.alias("lower_bound_ip_address"),
        (lower + RANGE_WIDTH).alias("upper_bound_ip_address"),
        F.col("n_name").alias("country"),
    )


def dirty_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """All transactions plus repeats, with text times, bad times and nulls."""
    base = transactions(spark, folder)
    event_id = F.col("event_id")
    copies = F.when(event_id % 10 == 0, 2).otherwise(1)
    repeated = base.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")

    def text(name: str) -> Column:
        return F.substring(F.col(name).cast("string"), 1, 19)

    def gap(divisor: int, name: str) -> Column:
        return F.when(event_id % divisor != 0, F.col(name)).alias(name)

    return repeated.select(
        "event_id", "user_id",
        F.when(event_id % 17 == 0, "not-a-time").otherwise(text("signup_time")).alias("signup_time"),
        text("purchase_time").alias("purchase_time"),
        gap(11, "purchase_value"), "device_id", "source", gap(7, "browser"), "sex",
        gap(13, "age"), "ip_address", gap(19, "class"),
    )


def ip_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Dotted addresses with nulls, words, leading zeros and octets above 255."""
    event_id = F.col("event_id")
    n = F.col("n")

    def octet(divisor: int) -> Column:
        return (F.floor(n / divisor).cast("long") % 256).cast("string")

    dotted = F.concat_ws(".", octet(2**24), octet(2**16), octet(2**8), octet(1))
    return (
        given(spark, folder, "events")
        .select("event_id", (event_id * IP_MULTIPLIER % IP_SPACE).alias("n"))
        .select(
            "event_id",
            F.when(event_id % 29 == 0, F.lit(None).cast("string"))
            .when(event_id % 23 == 0, "not-an-ip")
            .when(event_id % 31 == 0, "192.168.00.1")
            .when(event_id % 37 == 0, "300.1.1.1")
            .otherwise(dotted).alias("ip_text"),
        )
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Two models' scores for every transaction, with many ties."""
    event_id = F.col("event_id")
    strong = F.round(
        (event_id * 37 % 101).cast("double") / F.lit(101.0) * F.lit(0.7) + F.lit(0.3) * F.col("class"), 4)
    weak = F.round((event_id * 53 % 97).cast("double") / F.lit(97.0), 4)
    models = F.explode(F.array(
        F.struct(F.lit("model_a").alias("model_name"), strong.alias("score")),
        F.struct(F.lit("model_b").alias("model_name"), weak.alias("score")),
    ))
    label = F.when(F.col("event_type") == "error", 1).otherwise(0).cast("int")
    return (
        given(spark, folder, "events")
        .select("event_id", label.alias("class"))
        .select("event_id", F.col("class").alias("y"), models.alias("m"))
        .select("event_id", "m.model_name", "y", "m.score")
    )


def cards(spark: SparkSession, folder: str) -> DataFrame:
    """Card-table stand-in: all line items, every 50th order repeated."""
    order = F.col("l_orderkey")
    copies = F.when(order % 50 == 0, 2).otherwise(1)
    rare = (F.col("l_discount") > F.lit(0.095)) & (F.col("l_tax") > F.lit(0.075))
    return (
        given(spark, folder, "lineitem")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .select(
            order.cast("double").alias("time"),
            F.col("l_quantity").alias("v1"), F.col("l_discount").alias("v2"), F.col("l_tax").alias("v3"),
            F.when(order % 12 != 0, F.col("l_extendedprice")).alias("amount"),
            F.when(rare, 1).otherwise(0).cast("int").alias("class"),
        )
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as double arrays; label 0 is the rare class."""
    return given(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"),
        F.when(F.col("label") == 0, 1).otherwise(0).cast("int").alias("class"),
    )

"""Country lookup: the latest range that starts at or below an address, if it reaches it.

The as-of rule is turned into plain containment first. Cutting every range just before the
next one starts leaves disjoint intervals, and an address lies in a cut interval exactly when
the as-of rule would pick that range and find the address below its upper bound. Containment
then becomes an equi-join on a /16 block with the bounds as a residual condition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.functions.checks import require_columns
from txnlens.functions.ip import IPV4_MAX, ip_to_integer

LOWER, UPPER, COUNTRY = "lower_bound_ip_address", "upper_bound_ip_address", "country"
UNKNOWN = "unknown"
BLOCK = 65_536


def add_ip_integer(df: DataFrame, *, ip_column: str = "ip_address",
                   output_column: str = "ip_address_int") -> DataFrame:
    require_columns(df, [ip_column])
    return df.withColumn(output_column, ip_to_integer(F.col(ip_column), df.schema[ip_column].dataType))


def disjoint_ranges(ranges: DataFrame, *, country_column: str = COUNTRY) -> DataFrame:
    """Ranges cut so that no two overlap: ``lower``, ``upper``, ``country``.

    Of several ranges with one lower bound the longest is kept, then the first country by
    name (a missing name last). Bounds are IPv4 integers, so there are at most 65,536 blocks: the only window
    without a wide partition key runs over one row per block.
    """
    require_columns(ranges, [LOWER, UPPER, country_column])
    block = F.floor(F.col("lower") / BLOCK)
    unique = (
        ranges.select(F.col(LOWER).cast("long").alias("lower"), F.col(UPPER).cast("long").alias("upper"),
                      F.col(country_column).alias("country"))
        .where(F.col("lower").between(0, IPV4_MAX) & F.col("upper").isNotNull())
        .groupBy("lower")
        .agg(F.min(F.struct((-F.col("upper")).alias("reversed"), F.col("country").isNull().alias("unnamed"), "country")).alias("first"))
        .select("lower", (-F.col("first.reversed")).alias("upper"), F.col("first.country").alias("country"),
                block.alias("block"))
    )
    next_block = (
        unique.groupBy("block").agg(F.min("lower").alias("block_start"))
        .select("block", F.lead("block_start").over(W.orderBy("block")).alias("next_start"))
    )
    following = F.coalesce(F.lead("lower").over(W.partitionBy("block").orderBy("lower")), F.col("next_start"))
    return (
        unique.join(F.broadcast(next_block), "block", "left")
        .withColumn("following", following)
        .select("lower",
                F.least(F.col("upper"), F.coalesce(F.col("following") - 1, F.col("upper")),
                        F.lit(IPV4_MAX).cast("long")).alias("upper"),
                "country")
        .where(F.col("upper") >= F.col("lower"))
    )


def attach_country(events: DataFrame, ranges: DataFrame, *, ip_column: str = "ip_address_int",
                   country_column: str = COUNTRY, unknown: str = UNKNOWN,
                   max_broadcast_ranges: int = 1_000_000, salts: int = 32) -> DataFrame:
    """Left lookup that keeps every event; no match or no address gives ``unknown``.

    Up to ``max_broadcast_ranges`` ranges (counted first) the exploded side has at most that
    many rows plus 65,536 and is broadcast, so the events are never shuffled. A larger range
    table is joined by shuffle and salted with the row's place in its partition (any salt finds the
    same range, so no column is read for it): a block, or the null address, that holds a third of
    the events spreads over ``salts`` tasks, and adaptive skew splitting divides what is left.
    """
    require_columns(events, [ip_column])
    small = ranges.limit(max_broadcast_ranges + 1).count() <= max_broadcast_ranges
    blocks = F.sequence(F.floor(F.col("lower") / BLOCK), F.floor(F.col("upper") / BLOCK))
    lookup = disjoint_ranges(ranges, country_column=country_column).select(
        F.col("lower").alias("_lower"), F.col("upper").alias("_upper"),
        F.col("country").alias("_country"), F.explode(blocks).alias("_block"))

    probe = events.drop(country_column).withColumn("_ip_block", F.floor(F.col(ip_column) / BLOCK))
    matches = (
        (F.col("_ip_block") == F.col("_block"))
        & F.col(ip_column).between(F.col("_lower"), F.col("_upper"))
    )
    if small:
        lookup = F.broadcast(lookup)
    else:
        lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        probe = probe.withColumn("_row_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        matches = matches & (F.col("_row_salt") == F.col("_salt"))
    kept = [c for c in events.columns if c != country_column]
    return probe.join(lookup, matches, "left").select(
        *kept, F.coalesce("_country", F.lit(unknown)).alias(country_column))


def match_quality(df: DataFrame, *, country_column: str = COUNTRY, unknown: str = UNKNOWN) -> DataFrame:
    """One row: events, matched, matched share, unmatched, distinct matched countries."""
    per_country = df.groupBy(country_column).agg(F.count("*").alias("n"))
    known = F.col(country_column) != unknown
    return (
        per_country.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("matched"),
            F.count_if(known).alias("countries"),
        )
        .select("total", "matched",
                F.round(F.try_divide(F.col("matched") * 100.0, F.col("total")), 2).alias("matched_pct"),
                (F.col("total") - F.col("matched")).alias("unmatched"), "countries")
    )

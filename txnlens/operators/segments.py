"""Fraud rates and distributions by segment."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.functions.checks import require_columns
from txnlens.functions.labels import class_name
from txnlens.functions.numbers import percent, ratio
from txnlens.operators.correlation import vector_correlations
from txnlens.operators.quantiles import quantile_frame, quantile_values

# Right-closed age bands (lower, upper, name); the first one includes 0.
AGE_BANDS = ((0, 25, "<=25"), (25, 35, "26-35"), (35, 45, "36-45"), (45, 55, "46-55"), (55, 100, "56+"))
#: Up to so many columns a correlation matrix is one expression a pair.
PAIRED_COLUMNS = 12


def rate_by(df: DataFrame, column: str, *, label: str = "class", min_transactions: int = 0,
            digits: int = 3, ordered: bool = True) -> DataFrame:
    """Per segment: labelled rows, fraud cases and rate in percent, highest rate first.

    Rows without a segment form a group of their own.
    """
    require_columns(df, [column, label])
    table = (
        df.groupBy(column)
        .agg(F.count(label).alias("transactions"), F.sum(F.col(label).cast("long")).alias("fraud_cases"))
        .where(F.col("transactions") >= min_transactions)
        .withColumn("fraud_rate_pct", percent(F.col("fraud_cases"), F.col("transactions"), digits))
    )
    return table.orderBy(F.col("fraud_rate_pct").desc_nulls_last(), column) if ordered else table


def rates_by_segment(df: DataFrame, columns: Sequence[str], *, label: str = "class", digits: int = 3) -> DataFrame:
    """``rate_by`` for several columns in one aggregation: ``segment``, ``value``, counts, rate."""
    require_columns(df, [*columns, label])
    grouped = df.select(*[F.col(c).cast("string").alias(c) for c in columns], F.col(label).cast("long").alias("_y"))
    sets = grouped.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(
        F.count("_y").alias("transactions"), F.sum("_y").alias("fraud_cases"),
        *[F.grouping(F.col(c)).alias(f"_without_{c}") for c in columns])
    segment, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in columns:
        chosen = F.col(f"_without_{c}") == 0
        segment = F.when(chosen, F.lit(c)).otherwise(segment)
        value = F.when(chosen, F.col(c)).otherwise(value)
    return sets.select(segment.alias("segment"), value.alias("value"), "transactions", "fraud_cases",
                       percent(F.col("fraud_cases"), F.col("transactions"), digits).alias("fraud_rate_pct"))


def age_band(age: Column) -> Column:
    band = F.lit(None).cast("string")
    for low, high, name in AGE_BANDS:
        above = age >= low if low == 0 else age > low
        band = F.when(above & (age <= high), F.lit(name)).otherwise(band)
    return band


def rate_by_age_band(df: DataFrame, *, age_column: str = "age", label: str = "class") -> DataFrame:
    """Rates per age band; a band nobody falls into shows zero rows and no rate."""
    rates = rate_by(df.select(age_band(F.col(age_column)).alias("age_band"), label), "age_band",
                    label=label, ordered=False)
    spark = df.sparkSession
    bands = spark.createDataFrame([(name,) for *_, name in AGE_BANDS], "age_band string")
    return bands.join(rates, "age_band", "full").select(
        "age_band", F.coalesce("transactions", F.lit(0)).alias("transactions"),
        F.coalesce("fraud_cases", F.lit(0)).alias("fraud_cases"), "fraud_rate_pct")


def quantile_band(value: Column, edges: Sequence[float]) -> Column:
    """1-based right-closed band; the first band includes the lowest edge."""
    inner = sorted(set(edges))
    if not inner:
        return F.lit(None).cast("int")
    band = F.lit(1)
    for edge in inner[1:-1]:
        band = band + F.when(value > edge, 1).otherwise(0)
    return F.when(value.between(inner[0], inner[-1]), band)


def rate_by_quantile_band(df: DataFrame, value_column: str, *, bands: int = 4, label: str = "class",
                          approx: int | None = None) -> DataFrame:
    """Rates per quantile band, with linear-interpolated edges; equal edges merge."""
    probabilities = [i / bands for i in range(bands + 1)]
    edges = quantile_values(df, [value_column], probabilities, approx=approx)[value_column]
    known = [e for e in edges if e is not None]
    banded = df.select(quantile_band(F.col(value_column), known).alias("band"), label)
    return rate_by(banded, "band", label=label, ordered=False)


def mean_rate_by(df: DataFrame, column: str, *, label: str = "class", min_transactions: int = 0,
                 top: int | None = None) -> DataFrame:
    """All rows and mean label per non-null segment; optional row floor and top-n."""
    require_columns(df, [column, label])
    table = (
        df.where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("transactions"), F.avg(F.col(label).cast("double")).alias("fraud_rate"))
        .where(F.col("transactions") >= min_transactions)
    )
    ranked = table.orderBy(F.col("fraud_rate").desc_nulls_last(), column)
    return ranked if top is None else ranked.limit(top)


def top_values(df: DataFrame, column: str, n: int = 8) -> DataFrame:
    """Most frequent non-null values."""
    require_columns(df, [column])
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), column).limit(n)
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations as (``a``, ``b``, ``r``).

    Few columns take one pass with an expression a pair, more than ``PAIRED_COLUMNS`` the blocks of products.
    """
    require_columns(df, columns)
    if len(columns) > PAIRED_COLUMNS:
        packed = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
        names = F.array(*[F.lit(c) for c in columns])
        return vector_correlations(packed, "v").select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), "r")
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sums = wide.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"r{i}").alias("r")))
    return sums.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, column: str, *, bins: int = 40, low: float | None = None,
              high: float | None = None, cap: float | None = None, by: str | None = None) -> DataFrame:
    """Equal-width counts over all rows: ``bin`` 0..bins-1, its edges and row count.

    Missing limits come from one min/max pass. Values at or beyond a limit fall into the
    outer bin, so with ``cap`` the last bin also holds everything above it.
    """
    require_columns(df, [column] + ([by] if by else []))
    value = F.col(column).cast("double")
    if cap is not None:
        value = F.when(value.isNotNull(), F.least(value, F.lit(float(cap))))
    data = df.select(value.alias("_v"), *([by] if by else [])).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if low is None or high is None:
        seen = data.agg(F.min("_v"), F.max("_v")).first()
        low = seen[0] if low is None else low
        high = seen[1] if high is None else high
    if low is None or high is None:
        low, high = 0.0, 0.0
    width = (high - low) / bins or 1.0
    index = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.lit(low)) / F.lit(width))))
    keys = ([by] if by else []) + ["bin"]
    return (
        data.withColumn("bin", index.cast("int")).groupBy(*keys).agg(F.count("*").alias("count"))
        .select(*keys, (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
                (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"), "count")
    )


def box_stats(df: DataFrame, columns: Sequence[str], *, by: str = "class", approx: int | None = None) -> DataFrame:
    """Box-plot numbers per class and column: quartiles and the 1.5-IQR whiskers."""
    require_columns(df, [*columns, by])
    wide = quantile_frame(df, columns, [0.25, 0.5, 0.75], by=by, approx=approx).groupBy(by, "column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
          for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    long = df.select(F.col(by), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in columns])))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    # One row per (class, column) with its quartiles: classes times columns.
    return (
        long.join(F.broadcast(wide), [by, "column"])
        .groupBy(by, "column", "q1", "median", "q3")
        .agg(F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
             F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
             F.count("_v").alias("count"))
    )


def kpis(df: DataFrame, *, label: str = "class") -> DataFrame:
    """Row count, fraud cases and fraud rate."""
    y = F.col(label)
    return df.agg(F.count("*").alias("transactions"), F.sum(y.cast("long")).alias("fraud_cases"),
                  F.avg(y.cast("double")).alias("fraud_rate"))


def dataset_kpis(df: DataFrame, *, user_column: str = "user_id", label: str = "class",
                 features: int = 0) -> DataFrame:
    """Rows, distinct users, fraud rate, feature count. Counts per user first, then once more."""
    y = F.col(label)
    per_user = df.groupBy(user_column).agg(
        F.count("*").alias("n"), F.count(y).alias("labelled"), F.sum(y.cast("long")).alias("fraud"))
    return per_user.agg(
        F.sum("n").alias("observations"), F.count(user_column).alias("users"),
        ratio(F.sum("fraud"), F.sum("labelled")).alias("fraud_rate"),
        F.lit(features).cast("long").alias("features"))


def class_counts(df: DataFrame, *, label: str = "class") -> DataFrame:
    """Named class sizes."""
    return (
        df.groupBy(F.col(label)).agg(F.count("*").alias("count"))
        .select(class_name(F.col(label)).alias("class_name"), "count")
    )


def headline_metrics(df: DataFrame, *, label: str = "class", hours_column: str = "time_since_signup_hours",
                     source_column: str = "source", browser_column: str = "browser",
                     approx: int | None = None) -> DataFrame:
    """One row of report facts: rate, imbalance, median hours per class, riskiest segments."""
    y = F.col(label)
    totals = df.agg(F.avg(y.cast("double")).alias("mean"), F.count_if(y == 0).alias("legit"),
                    F.count_if(y == 1).alias("fraud")).first()
    medians = {
        row[label]: row["value"]
        for row in quantile_frame(df.where(y.isin(0, 1)), [hours_column], [0.5], by=label, approx=approx).collect()
    }
    riskiest = {}
    for segment, value in ((r["segment"], r["value"]) for r in _riskiest(df, (source_column, browser_column), label)):
        riskiest[segment] = value
    smaller, larger = sorted((totals["legit"], totals["fraud"]))
    facts = [(
        None if totals["mean"] is None else totals["mean"] * 100.0,
        larger / smaller if smaller else None,
        medians.get(0), medians.get(1), riskiest.get(source_column), riskiest.get(browser_column),
    )]
    return _facts(df.sparkSession, facts)


def _riskiest(df: DataFrame, columns: Iterable[str], label: str) -> list:
    """The value with the highest rate per segment column (ties: first by name)."""
    rates = rates_by_segment(df, list(columns), label=label)
    return rates.groupBy("segment").agg(
        F.min_by("value", F.struct(-F.col("fraud_rate_pct"), F.col("value"))).alias("value")).collect()


def _facts(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(
        rows, "fraud_rate_pct double, imbalance_ratio double, median_hours_legit double, "
              "median_hours_fraud double, top_source string, top_browser string")


def value_kpis(df: DataFrame, *, label: str = "class", value_column: str = "purchase_value",
               hours_column: str = "time_since_signup_hours", approx: int | None = None) -> DataFrame:
    """Fraud rate, median value of all rows and median hours of legitimate rows."""
    rate = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    value = quantile_values(df, [value_column], [0.5], approx=approx)[value_column][0]
    hours = quantile_values(df.where(F.col(label) == 0), [hours_column], [0.5], approx=approx)[hours_column][0]
    return df.sparkSession.createDataFrame(
        [(rate, value, hours)], "fraud_rate double, median_value double, median_hours_legit double")

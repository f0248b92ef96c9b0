"""Feature importances of fitted models and facts drawn from result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.functions.labels import direction, feature_category, feature_text
from txnlens.operators.columns import stack_rows

IMPORTANCE_SCHEMA = "feature string, importance double, coefficient double"


def feature_importance(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Signed coefficients of a linear model or split importances of a tree model, largest first."""
    if hasattr(model, "coefficients"):
        rows = [(n, abs(float(c)), float(c)) for n, c in zip(names, model.coefficients.toArray(), strict=True)]
        kind, sign = "coefficient", direction(F.col("coefficient"))
    elif hasattr(model, "featureImportances"):
        rows = [(n, float(i), None) for n, i in zip(names, model.featureImportances.toArray(), strict=True)]
        kind, sign = "feature_importance", F.lit("n/a")
    else:
        raise TypeError(f"{type(model).__name__} has neither coefficients nor importances")
    table = spark.createDataFrame(rows, IMPORTANCE_SCHEMA).select(
        "feature", "importance", "coefficient", sign.alias("direction"), F.lit(kind).alias("importance_type"))
    return by_importance(table)


def by_importance(table: DataFrame, top_n: int | None = None) -> DataFrame:
    ranked = table.orderBy(F.col("importance").desc(), "feature")
    return ranked if top_n is None else ranked.limit(top_n)


def coefficient_extremes(table: DataFrame, *, top_n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(strongest positive, strongest negative) coefficients; linear models only."""
    if table.where(F.col("importance_type") != "coefficient").limit(1).count():
        raise ValueError("coefficients exist for linear models only")
    signed = F.col("coefficient")
    return (table.where(signed > 0).orderBy(signed.desc(), "feature").limit(top_n),
            table.where(signed < 0).orderBy(signed.asc(), "feature").limit(top_n))


def labelled_features(table: DataFrame) -> DataFrame:
    """Adds a plain-language text and a category to a feature table."""
    return table.withColumns({
        "label": feature_text(F.col("feature")), "category": feature_category(F.col("feature"))})


def insight_facts(comparison: DataFrame, importance: DataFrame, *, baseline: str = "logistic_regression",
                  top_n: int = 10) -> DataFrame:
    """One row of report facts from a model comparison and a feature importance table."""
    best = F.struct(-F.col("pr_auc"), F.col("model_name"))

    def of_best(name: str) -> Column:
        return F.min_by(name, best).alias(name)

    models = comparison.agg(
        of_best("model_name"), of_best("pr_auc"), of_best("precision"), of_best("recall"), of_best("f1"),
        of_best("roc_auc"), of_best("true_positives"), of_best("false_positives"), of_best("false_negatives"),
        of_best("true_negatives"),
        F.max(F.when(F.col("model_name") == baseline, F.col("pr_auc"))).alias("baseline_pr_auc"))
    category, feature = feature_category(F.col("feature")), F.col("feature")
    features = by_importance(importance, top_n).agg(
        F.max_by("feature", F.struct(F.col("importance"))).alias("top_feature"),
        F.max("importance").alias("top_importance"),
        F.count_if(category == "behavioral_timing").alias("timing_features"),
        F.count_if(feature.startswith("country_")).alias("country_features"),
        F.count_if(feature.startswith("source_")).alias("source_features"),
        F.count_if(feature.startswith("browser_")).alias("browser_features"),
        F.coalesce(F.max(feature == "source_Direct"), F.lit(False)).alias("direct_channel_in_top"))
    total = F.col("true_positives") + F.col("false_positives") + F.col("false_negatives") + F.col("true_negatives")
    # Two one-row tables become one by stacking, which needs no join.
    both = stack_rows([models, features])
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("holdout_rows", total)

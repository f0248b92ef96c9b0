"""Classifiers: a registry, fitting and scoring."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.checks import require_columns
from txnlens.operators.columns import stack_rows
from txnlens.operators.ranking import compare_models
from txnlens.operators.sampling import add_class_weight

MODEL_NAMES = ("logistic_regression", "random_forest", "gradient_boosted_trees")
WEIGHT = "class_weight"


def default_estimator(name: str, *, rows: int, seed: int = 42, balanced: bool = True) -> Estimator:
    """An untuned estimator. ``rows`` scales the ridge penalty, so it means the same at any size.

    ``balanced`` weights classes in the linear model and the forest; boosted trees are never weighted.
    """
    common = {"featuresCol": "features", "labelCol": "class"}
    if balanced and name != "gradient_boosted_trees":
        common["weightCol"] = WEIGHT
    if name == "logistic_regression":
        return LogisticRegression(maxIter=1000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0,
                                  standardization=False, **common)
    if name == "random_forest":
        return RandomForestClassifier(numTrees=100, maxDepth=30, featureSubsetStrategy="sqrt", seed=seed,
                                      **common)
    if name == "gradient_boosted_trees":
        return GBTClassifier(maxIter=100, maxDepth=6, stepSize=0.1, seed=seed, **common)
    raise ValueError(f"unknown model: {name} (known: {', '.join(MODEL_NAMES)})")


def as_vectors(df: DataFrame, column: str = "features") -> DataFrame:
    """Turn an array column into the vector column Spark ML wants."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return df.withColumn(column, array_to_vector(F.col(column)))
    return df


def as_arrays(df: DataFrame, column: str = "features") -> DataFrame:
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return df
    return df.withColumn(column, vector_to_array(F.col(column)))


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where a small table would keep most of them idle."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def positive_score(df: DataFrame) -> Column:
    """Probability of class 1, else the margin."""
    for column in ("probability", "rawPrediction"):
        if column in df.columns:
            return F.get(vector_to_array(F.col(column)), F.lit(1))
    raise ValueError("the model gives neither probabilities nor margins")


@dataclass(frozen=True)
class TrainedModel:
    """A fitted model, its scores on the test rows and its metrics (one-row table)."""

    name: str
    model: Model
    scores: DataFrame
    metrics: DataFrame


def score_rows(model: Model, df: DataFrame, *, name: str, key: str, label: str = "class") -> DataFrame:
    """(``model_name``, ``key``, ``y``, ``score``, ``prediction``) for every row."""
    scored = model.transform(as_vectors(df))
    return scored.select(F.lit(name).alias("model_name"), key, F.col(label).cast("int").alias("y"),
                         positive_score(scored).alias("score"), F.col("prediction").cast("int").alias("prediction"))


def train_model(name: str, train: DataFrame, test: DataFrame, *, key: str, estimator: Estimator | None = None,
                seed: int = 42, balanced: bool = True, inverse_penalty: float | None = None) -> TrainedModel:
    """Fit on ``train`` (label ``class``, column ``features``), score ``test``.

    ``inverse_penalty`` sets the ridge penalty of a linear model relative to the rows it is fitted on.
    """
    require_columns(train, ["features", "class"])
    data = spread(as_vectors(train))
    if estimator is not None and inverse_penalty is not None:
        estimator = estimator.copy({estimator.getParam("regParam"): 1.0 / (inverse_penalty * max(data.count(), 1))})
    if estimator is None:
        estimator = default_estimator(name, rows=data.count(), seed=seed, balanced=balanced)
    if estimator.hasParam("weightCol") and estimator.isDefined("weightCol") and estimator.getOrDefault("weightCol") == WEIGHT:
        data = add_class_weight(data, output_column=WEIGHT)
    model = estimator.fit(data)
    scores = score_rows(model, test, name=name, key=key)
    return TrainedModel(name, model, scores, compare_models(scores, prediction="prediction"))


def train_models(names: Iterable[str], train: DataFrame, test: DataFrame, *, key: str,
                 seed: int = 42, balanced: bool = True) -> list[TrainedModel]:
    """Fit several models one after another; cache the inputs first."""
    return [train_model(n, train, test, key=key, seed=seed, balanced=balanced) for n in names]


def compare_trained(results: Iterable[TrainedModel], *, sort_by: str = "pr_auc", ascending: bool = False) -> DataFrame:
    """One row of metrics per model, computed in one pass over all scores."""
    models = list(results)
    if not models:
        raise ValueError("no models to compare")
    return compare_models(stack_rows([m.scores for m in models]), prediction="prediction",
                          sort_by=sort_by, ascending=ascending)


def pick_best(results: Iterable[TrainedModel], *, metric: str = "pr_auc") -> TrainedModel:
    models = {m.name: m for m in results}
    name = compare_trained(models.values(), sort_by=metric).first()["model_name"]
    return models[name]

"""Split, resample, tune, train, compare, explain."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.operators import attribution as at
from txnlens.operators.encoding import FeatureConfig, FittedEncoder, fit_encoder
from txnlens.operators.importance import by_importance, feature_importance
from txnlens.operators.profiling import compare_stages
from txnlens.operators.ranking import best_model_summary
from txnlens.operators.sampling import with_split
from txnlens.operators.smote import resample
from txnlens.operators.training import (
    MODEL_NAMES, TrainedModel, as_arrays, as_vectors, compare_trained, pick_best, train_model)
from txnlens.operators.tuning import TunedModel, tune_model, tuning_summary
from txnlens.session import materialize
from txnlens.sources.writers import write_all, write_table, write_top_features


@dataclass(frozen=True)
class PreparedData:
    """Encoded train and test rows (``key``, ``class``, ``features`` array) and their encoder."""

    train: DataFrame
    test: DataFrame
    encoder: FittedEncoder
    key: str


@dataclass(frozen=True)
class ResampledData:
    prepared: PreparedData
    train_resampled: DataFrame
    balance: DataFrame


@dataclass(frozen=True)
class ModelingResult:
    data: ResampledData
    tuned: list[TunedModel]
    trained: list[TrainedModel]
    comparison: DataFrame
    best: TrainedModel


@dataclass(frozen=True)
class AttributionResult:
    attributions: DataFrame
    top_features: DataFrame
    case: DataFrame
    waterfall: DataFrame
    dependence: DataFrame
    explained: DataFrame
    base: float | None
    beeswarm: DataFrame


def prepare(engineered: DataFrame, *, key: str = "event_id", config: FeatureConfig = FeatureConfig(),
            test_size: float = 0.2, seed: int = 42, fit_on: str = "train") -> PreparedData:
    """Split first, then fit the encoder on the train rows (``fit_on="all"``: on every row).

    The encoded rows are written once to the shared folder, since every later fit reads them
    many times.
    """
    tagged = with_split(engineered, key=key, label=config.target, test_size=test_size, seed=seed)
    train_rows = tagged.where(F.col("split") == "train")
    encoder = fit_encoder(train_rows if fit_on == "train" else engineered, config)
    encoded = as_arrays(encoder.vectors(tagged, keep=[key, "split"])).withColumnRenamed(config.target, "class")
    saved = materialize(encoded, "encoded", partition_by=["split"])
    train, test = (saved.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    return PreparedData(train, test, encoder, key)


def resample_train(prepared: PreparedData, *, strategy: str = "smote", seed: int = 42) -> ResampledData:
    """Resample the train rows only; the holdout keeps its natural balance."""
    resampled = materialize(resample(prepared.train, strategy, key=prepared.key, seed=seed), "resampled")
    balance = compare_stages({"train_before_resampling": prepared.train, "train_after_resampling": resampled,
                              "test_holdout_unmodified": prepared.test})
    return ResampledData(prepared, resampled, balance)


def resampling_job(engineered: DataFrame, folder: str, *, strategy: str = "smote", key: str = "event_id",
                   seed: int = 42, format: str = "parquet") -> ResampledData:
    """Split, encode, resample and write the class balance of every stage."""
    data = resample_train(prepare(engineered, key=key, seed=seed), strategy=strategy, seed=seed)
    write_table(data.balance, folder, "class_imbalance_comparison", format=format)
    return data


def run_modeling(engineered: DataFrame, *, models: Iterable[str] = MODEL_NAMES, key: str = "event_id",
                 test_size: float = 0.2, folds: int = 3, seed: int = 42, strategy: str = "smote",
                 searches: dict | None = None, report_folder: str | None = None) -> ModelingResult:
    """Tune on the original train rows, fit on the resampled ones, score the untouched holdout."""
    split = prepare(engineered, key=key, test_size=test_size, seed=seed)
    data = resample_train(split, strategy=strategy, seed=seed)
    tuned, trained = [], []
    for name in models:
        found = tune_model(name, split.train, key=key, folds=folds, seed=seed, search=(searches or {}).get(name))
        tuned.append(found)
        trained.append(train_model(name, data.train_resampled, split.test, key=key, estimator=found.estimator,
                                   inverse_penalty=found.best_params.get("C")))
    result = ModelingResult(data, tuned, trained, compare_trained(trained), pick_best(trained))
    if report_folder:
        save_report(result, report_folder)
    return result


def save_report(result: ModelingResult, folder: str, *, top_n: int = 20, format: str = "parquet") -> dict[str, str]:
    """Comparison, best-model summary, class balance, tuning summary and top features as tables."""
    spark = result.comparison.sparkSession
    importance = feature_importance(spark, result.best.model, result.data.prepared.encoder.names)
    paths = write_all({
        "model_comparison_metrics": result.comparison,
        "best_model_summary": best_model_summary(result.comparison),
        "class_imbalance_comparison": result.data.balance,
        "tuning_summary": tuning_summary(spark, result.tuned),
        "top_features_best_model": by_importance(importance, top_n),
    }, folder, format=format)
    paths["top_features"] = write_top_features(importance, folder, model_name=result.best.name, top_n=top_n,
                                               format=format)
    return paths


def explain(trained: TrainedModel, prepared: PreparedData, *, background_rows: int = at.BACKGROUND_ROWS,
            explained_rows: int = at.EXPLAINED_ROWS, top_n: int = 10, seed: int = 42,
            permutations: int = 10) -> AttributionResult:
    """Attributions by model kind, their ranking, one strong case and the top feature's dependence."""
    key, names = prepared.key, prepared.encoder.names
    background, rows = at.sample_pair(prepared.train, prepared.test, key=key, background_rows=background_rows,
                                      explained_rows=explained_rows, seed=seed)
    values, base = attribute(trained.model, rows, background, names, key=key, permutations=permutations, seed=seed)
    values = materialize(values, "attributions")
    top = at.rank_features(values, top_n=top_n)
    case = at.strongest_case(trained.scores.join(rows.select(key), key, "left_semi"), key=key)
    return AttributionResult(
        values, top, case, at.waterfall(values.join(case.select(key), key, "left_semi"), key=key),
        at.dependence(values, rows, names, top.first()["feature"], key=key), rows, base,
        at.beeswarm(values, rows, names, key=key))


def attribution_job(engineered: DataFrame, folder: str, *, result: ModelingResult | None = None, model: TrainedModel | None = None,
                    key: str = "event_id", test_size: float = 0.2, split_seed: int = 42, format: str = "parquet",
                    **options) -> AttributionResult:
    """Explain the best model of ``result``, or ``model``, or one trained here, and write the tables.

    A ``model`` comes without its rows: the split and encoding, which follow from the engineered table, the key and the
    seed, are made again.
    """
    if model is not None:
        best, prepared = model, prepare(engineered, key=key, test_size=test_size, seed=split_seed)
    else:
        result = result or run_modeling(engineered, key=key, test_size=test_size, seed=split_seed)
        best, prepared = result.best, result.data.prepared
    found = explain(best, prepared, **options)
    write_all({"shap_top_features": found.top_features, "shap_waterfall": found.waterfall, "shap_dependence": found.dependence,
               "shap_beeswarm": found.beeswarm}, folder, format=format)
    return found


def attribute(model, rows: DataFrame, background: DataFrame, names: Sequence[str], *, key: str,
              permutations: int = 10, seed: int = 42) -> tuple[DataFrame, float | None]:
    """(attributions, expected score) by the method that fits the model."""
    if isinstance(model, RandomForestClassificationModel):
        return at.tree_attribution(rows, model, names, key=key)
    if hasattr(model, "coefficients"):
        means = at.background_means(background)
        coefficients = [float(c) for c in model.coefficients.toArray()]
        base = float(model.intercept) + sum(c * m for c, m in zip(coefficients, means, strict=True))
        return at.linear_attribution(rows, coefficients, means, names, key=key), base
    if isinstance(model, GBTClassificationModel):
        return at.boosted_attribution(rows, background, model, names, key=key)
    scored = model.transform(as_vectors(background))
    base = scored.agg(F.avg(at.positive_score(scored))).first()[0]
    return at.sampled_attribution(rows, background, model, names, key=key, permutations=permutations, seed=seed), base

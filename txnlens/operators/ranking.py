"""Ranking metrics over scores: average precision, ROC-AUC and the curves behind them.

Everything starts from one table with a row per distinct score and the running counts down to
it. Rows with equal scores collapse in the first aggregation. Beyond ``WINDOW_ROWS`` distinct
scores the running counts come from a range partition by (model, score) whose stretches carry
the totals of the earlier ones, so their number follows the rows and no task sees a whole model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.functions.checks import require_columns
from txnlens.functions.numbers import ratio, ratio_or_zero
from txnlens.operators.running import ROWS_PER_STRETCH, running_sums
from txnlens.session import materialize

#: Up to so many distinct scores of all models, one window a model is enough.
WINDOW_ROWS = 200_000
CONFUSION = ("true_positives", "false_positives", "false_negatives", "true_negatives")


def score_steps(df: DataFrame, *, label: str = "y", score: str = "score", model: str = "model_name",
                window_rows: int = WINDOW_ROWS, rows_per_stretch: int = ROWS_PER_STRETCH) -> DataFrame:
    """Per model and distinct score, from the highest score down.

    ``positives``/``rows`` at the score, ``tp``/``flagged`` at or above it, and the model's
    ``total_positives``/``total_rows``.
    """
    require_columns(df, [label, score, model])
    steps = materialize(
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(model).alias("model_name"), F.col(score).cast("double").alias("score"))
        .agg(F.sum(F.col(label).cast("long")).alias("positives"), F.count("*").alias("rows")), "score-steps")
    sums = {"tp": F.col("positives"), "flagged": F.col("rows")}
    totals = {"total_positives": "positives", "total_rows": "rows"}
    n = steps.count()
    if n <= window_rows:
        per_model = W.partitionBy("model_name")
        down = per_model.orderBy(F.col("score").desc())
        return steps.select("*", *[F.sum(c).over(down).alias(name) for name, c in sums.items()],
                            *[F.sum(c).over(per_model).alias(name) for name, c in totals.items()])
    running = running_sums(steps, ["model_name"], [F.col("score").desc()], sums, n_rows=n, rows_per_stretch=rows_per_stretch, label="score-sums")
    whole = steps.groupBy("model_name").agg(*[F.sum(c).alias(name) for name, c in totals.items()])
    return running.alias("r").join(whole.alias("w"), F.col("r.model_name").eqNullSafe(F.col("w.model_name"))).select(
        "r.*", *[F.col(f"w.{name}") for name in totals])


def ranking_metrics(df: DataFrame, **columns) -> DataFrame:
    """``roc_auc`` (ties by trapezoid) and ``pr_auc`` (average precision, step sum) per model."""
    return score_steps(df, **columns).groupBy("model_name").agg(*_areas())


def _areas() -> list[Column]:
    """Aggregates over score steps."""
    negatives = F.col("rows") - F.col("positives")
    total_negatives = F.max(F.col("total_rows") - F.col("total_positives"))
    total_positives = F.max("total_positives")
    area = F.sum(negatives.cast("double") * (F.col("tp") - F.col("positives") / F.lit(2.0)))
    gain = F.sum(F.col("positives").cast("double") * F.col("tp") / F.col("flagged"))
    return [ratio(area, total_positives * total_negatives).alias("roc_auc"),
            ratio(gain, total_positives).alias("pr_auc")]


def pr_curve(df: DataFrame, **columns) -> DataFrame:
    """Precision and recall at every distinct score, plus the closing point (1, 0)."""
    return _curve(df, columns, {
        "precision": (ratio(F.col("tp"), F.col("flagged")), 1.0),
        "recall": (ratio(F.col("tp"), F.col("total_positives")), 0.0)})


def roc_curve(df: DataFrame, **columns) -> DataFrame:
    """False and true positive rates at every distinct score, plus the opening point (0, 0)."""
    false_positives = F.col("flagged") - F.col("tp")
    negatives = F.col("total_rows") - F.col("total_positives")
    return _curve(df, columns, {
        "fpr": (ratio(false_positives, negatives), 0.0),
        "tpr": (ratio(F.col("tp"), F.col("total_positives")), 0.0)})


def _curve(df: DataFrame, columns: dict, values: dict) -> DataFrame:
    """Points of a curve; the row of a model's lowest score also brings the extra end point."""
    point = F.struct(F.col("score").alias("threshold"), *[value.alias(n) for n, (value, _) in values.items()])
    end = F.struct(F.lit(None).cast("double").alias("threshold"), *[F.lit(at_end).alias(n) for n, (_, at_end) in values.items()])
    points = F.when(F.col("flagged") == F.col("total_rows"), F.array(point, end)).otherwise(F.array(point))
    return score_steps(df, **columns).select("model_name", F.inline(points))


def no_skill_baseline(df: DataFrame, *, label: str = "y", model: str = "model_name") -> DataFrame:
    """The precision of flagging everything: the share of positives."""
    return df.groupBy(F.col(model).alias("model_name")).agg(
        F.avg(F.col(label).cast("double")).alias("baseline_precision"))


def predict_at(df: DataFrame, *, score: str = "score", threshold: float = 0.5,
               output_column: str = "prediction") -> DataFrame:
    """1 where the score is above the threshold."""
    return df.withColumn(output_column, (F.col(score) > F.lit(threshold)).cast("int"))


def threshold_metrics(df: DataFrame, *, label: str = "y", prediction: str = "prediction",
                      model: str = "model_name") -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 per model; 0 on zero division."""
    require_columns(df, [label, prediction, model])
    y, p = F.col(label), F.col(prediction)
    counts = df.groupBy(F.col(model).alias("model_name")).agg(
        F.count_if((y == 1) & (p == 1)).alias("true_positives"),
        F.count_if((y == 0) & (p == 1)).alias("false_positives"),
        F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
        F.count_if((y == 0) & (p == 0)).alias("true_negatives"))
    return counts.select("model_name", *_rates(), *CONFUSION)


def _rates() -> list[Column]:
    tp, fp, fn, tn = (F.col(c) for c in CONFUSION)
    return [ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("accuracy"),
            ratio_or_zero(tp, tp + fp).alias("precision"), ratio_or_zero(tp, tp + fn).alias("recall"),
            ratio_or_zero(tp * 2, tp * 2 + fp + fn).alias("f1")]


def confusion_table(df: DataFrame, *, label: str = "y", prediction: str = "prediction",
                    labels: tuple[int, ...] = (0, 1), model: str | None = None) -> DataFrame:
    """A row per actual class, a column per predicted class; empty cells are 0."""
    keys = [F.col(model).alias("model_name")] if model else []
    y, p = F.col(label), F.col(prediction)
    cells = [F.count_if((y == a) & (p == b)).alias(f"c{a}_{b}") for a in labels for b in labels]
    wide = df.groupBy(*keys).agg(*cells)
    rows = F.array(*[
        F.struct(F.lit(f"actual_{a}").alias("actual"), *[F.col(f"c{a}_{b}").alias(f"predicted_{b}") for b in labels])
        for a in labels])
    return wide.select(*(["model_name"] if model else []), F.inline(rows))


def compare_models(df: DataFrame, *, label: str = "y", score: str = "score", model: str = "model_name",
                   prediction: str | None = None, threshold: float = 0.5,
                   sort_by: str = "pr_auc", ascending: bool = False) -> DataFrame:
    """All metrics, one row per model, best first. ``auc_pr`` may be used for ``pr_auc``.

    Without a ``prediction`` column the confusion counts at ``threshold`` come from the score
    steps as well, so one aggregation gives every metric.
    """
    if prediction is None:
        above = F.col("score") > F.lit(threshold)
        positives, negatives = F.col("positives"), F.col("rows") - F.col("positives")
        table = score_steps(df, label=label, score=score, model=model).groupBy("model_name").agg(
            *[F.sum(F.when(side, n).otherwise(0)).alias(name) for name, side, n in zip(
                CONFUSION, (above, above, ~above, ~above), (positives, negatives, positives, negatives), strict=True)],
            *_areas()).select("model_name", *_rates(), *CONFUSION, "roc_auc", "pr_auc")
    else:
        at_threshold = threshold_metrics(df, label=label, prediction=prediction, model=model)
        table = at_threshold.join(
            ranking_metrics(df, label=label, score=score, model=model), "model_name", "left")
    by = F.col("pr_auc" if sort_by == "auc_pr" else sort_by)
    return table.orderBy(by.asc_nulls_last() if ascending else by.desc_nulls_last(), "model_name")


def best_model(comparison: DataFrame, *, metric: str = "pr_auc") -> DataFrame:
    """The row with the highest metric (ties: first name)."""
    return comparison.orderBy(F.col(metric).desc_nulls_last(), "model_name").limit(1)


def best_model_summary(comparison: DataFrame, *, metric: str = "pr_auc") -> DataFrame:
    """One row: the best model's metrics, the runner-up and the lead over it (null if alone)."""
    # The comparison has one row per model, so its ranking is a window over a few rows.
    order = W.orderBy(F.col(metric).desc_nulls_last(), "model_name")
    ranked = comparison.select(
        "*", F.lead("model_name").over(order).alias("runner_up_model"),
        (F.col(metric) - F.lead(metric).over(order)).alias("pr_auc_gap_vs_runner_up"),
        F.row_number().over(order).alias("_place"))
    return ranked.where(F.col("_place") == 1).select(
        "model_name", "runner_up_model", F.lit(metric).alias("selection_metric"),
        "precision", "recall", "f1", "roc_auc", "pr_auc", "pr_auc_gap_vs_runner_up",
        "true_positives", "false_positives", "false_negatives", "true_negatives")


def holdout_rates(comparison: DataFrame) -> DataFrame:
    """Fraud caught out of all fraud, and false alarms out of all legitimate rows."""
    fraud = F.col("true_positives") + F.col("false_negatives")
    legit = F.col("true_negatives") + F.col("false_positives")
    return comparison.select(
        "model_name", "true_positives", fraud.alias("total_fraud"),
        ratio_or_zero(F.col("true_positives"), fraud).alias("fraud_caught_rate"),
        "false_positives", legit.alias("total_legit"),
        ratio_or_zero(F.col("false_positives"), legit).alias("false_alarm_rate"))

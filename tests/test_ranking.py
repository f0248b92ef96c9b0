import random

import pytest

from txnlens.operators import ranking, running

SCHEMA = "model_name string, y int, score double"


def data(seed=1, n=700):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        out.append(("coarse", y, round(rng.random() * 0.7 + 0.3 * y, 1)))
        out.append(("fine", y, rng.random() ** 4 * (1 + y)))
    return out


def brute(rows, model):
    mine = [(s, y) for m, y, s in rows if m == model]
    positives = sum(y for _, y in mine)
    negatives = len(mine) - positives
    ap = auc = 0.0
    tp = fp = 0
    for score in sorted({s for s, _ in mine}, reverse=True):
        p = sum(y for s, y in mine if s == score)
        n = sum(1 for s, _ in mine if s == score) - p
        auc += n * (tp + p / 2)
        tp, fp = tp + p, fp + n
        ap += p * tp / (tp + fp)
    return auc / (positives * negatives), ap / positives


@pytest.mark.parametrize("sizes", [{}, {"window_rows": 0}, {"window_rows": 0, "rows_per_stretch": 60}])
def test_auc_and_average_precision(spark, sizes):
    rows = data()
    table = {r["model_name"]: (r["roc_auc"], r["pr_auc"])
             for r in ranking.ranking_metrics(spark.createDataFrame(rows, SCHEMA), **sizes).collect()}
    for model in ("coarse", "fine"):
        assert table[model] == pytest.approx(brute(rows, model))


def test_average_precision_is_a_step_sum(spark):
    rows = [("m", y, s) for y, s in [(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.7), (0, 0.4), (0, 0.3), (1, 0.2)]]
    got = ranking.ranking_metrics(spark.createDataFrame(rows, SCHEMA)).first()["pr_auc"]
    assert got == pytest.approx(brute(rows, "m")[1])


def test_running_sums_equal_one_window(spark, rows):
    df = spark.createDataFrame(data(2) + [(None, 1, 0.5), (None, 0, 0.25)], SCHEMA)
    order = ["model_name", "score", "positives", "rows", "tp", "flagged", "total_positives", "total_rows"]
    assert rows(ranking.score_steps(df, window_rows=0, rows_per_stretch=50).select(order)) == rows(ranking.score_steps(df).select(order))


def test_ten_times_the_scores_take_ten_times_the_stretches(spark, monkeypatch):
    """One model: the rows a task stay alike, whatever the table's size."""
    seen = []
    keep = running.materialize
    monkeypatch.setattr(running, "materialize", lambda df, label, **b: seen.append(keep(df, label, **b)) or seen[-1])
    largest = []
    for n in (3_000, 30_000):
        df = spark.range(n).selectExpr("'m' AS model_name", "cast(id % 3 = 0 AS int) AS y", "id / 7.0 AS score")
        assert ranking.score_steps(df, window_rows=0, rows_per_stretch=1_000).count() == n
        largest.append(max(r["count"] for r in seen[-1].groupBy("__part").count().collect()))
    assert largest[1] < 2 * largest[0] and largest[1] < 3_000


def test_threshold_metrics(spark):
    df = spark.createDataFrame([("m", 0, 0), ("m", 0, 1), ("m", 1, 1), ("m", 1, 0)], "model_name string, y int, prediction int")
    row = ranking.threshold_metrics(df).first()
    assert [row[c] for c in ("accuracy", "precision", "recall", "f1")] == [0.5] * 4
    nothing = ranking.threshold_metrics(df.withColumn("prediction", df["y"] * 0)).first()
    assert (nothing["precision"], nothing["f1"]) == (0.0, 0.0)


def test_confusion_table_has_all_cells(spark, rows):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, prediction int")
    assert rows(ranking.confusion_table(df)) == [("actual_0", 2, 0), ("actual_1", 1, 0)]


def test_curves_end_where_they_should(spark):
    df = spark.createDataFrame(data(), SCHEMA)
    pr = ranking.pr_curve(df).where("model_name = 'coarse'").orderBy("recall").collect()
    assert (pr[0]["recall"], pr[0]["precision"], pr[0]["threshold"]) == (0.0, 1.0, None)
    assert pr[-1]["recall"] == 1.0
    roc = ranking.roc_curve(df).where("model_name = 'coarse'").orderBy("fpr", "tpr").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"], roc[-1]["fpr"], roc[-1]["tpr"]) == (0.0, 0.0, 1.0, 1.0)


def test_comparison_and_best_model(spark):
    table = ranking.compare_models(spark.createDataFrame(data(), SCHEMA), sort_by="auc_pr")
    assert [r["model_name"] for r in table.collect()] == ["fine", "coarse"] or table.first()["pr_auc"] >= table.collect()[1]["pr_auc"]
    summary = ranking.best_model_summary(table).first()
    assert summary["model_name"] == ranking.best_model(table).first()["model_name"]
    assert summary["pr_auc_gap_vs_runner_up"] >= 0
    alone = ranking.best_model_summary(table.where("model_name = 'fine'")).first()
    assert (alone["runner_up_model"], alone["pr_auc_gap_vs_runner_up"]) == (None, None)


def test_holdout_rates(spark):
    df = spark.createDataFrame([("m", 1492, 13, 1338, 27380)],
                               "model_name string, true_positives long, false_positives long, false_negatives long, true_negatives long")
    row = ranking.holdout_rates(df).first()
    assert (row["total_fraud"], row["total_legit"]) == (2830, 27393)
    assert row["fraud_caught_rate"] == pytest.approx(0.5272, abs=1e-4)

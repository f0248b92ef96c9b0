import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.sql import functions as F

from txnlens.operators import attribution as at
from txnlens.operators import importance, training, tuning
from txnlens.plans import modeling

NAMES = ["f1", "f2", "f3", "f4"]


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(42)
    rows = []
    for i in range(300):
        y = int(i % 5 == 0)
        rows.append((i, y, [rng.gauss(1.5 * y, 1), rng.gauss(0, 1), rng.gauss(-y, 1), float(rng.random() < 0.3)]))
    df = spark.createDataFrame(rows, "id long, class int, features array<double>").cache()
    df.count()
    return df


@pytest.fixture(scope="module")
def forest(matrix):
    estimator = RandomForestClassifier(numTrees=5, maxDepth=4, seed=1, labelCol="class")
    return training.train_model("random_forest", matrix, matrix, key="id", estimator=estimator)


def test_default_models_train_and_score(matrix):
    result = training.train_model("logistic_regression", matrix, matrix, key="id")
    scores = result.scores.collect()
    assert len(scores) == 300 and all(0 <= r["score"] <= 1 for r in scores)
    row = result.metrics.first()
    assert row["roc_auc"] > 0.7 and row["true_positives"] + row["false_negatives"] == 60
    with pytest.raises(ValueError, match="unknown model"):
        training.train_model("nope", matrix, matrix, key="id")


def test_compare_and_pick_best(matrix, forest):
    linear = training.train_model("logistic_regression", matrix, matrix, key="id")
    table = training.compare_trained([linear, forest]).collect()
    assert [r["pr_auc"] for r in table] == sorted((r["pr_auc"] for r in table), reverse=True)
    assert training.pick_best([linear, forest]).name == table[0]["model_name"]
    with pytest.raises(ValueError):
        training.compare_trained([])


def test_average_precision_evaluator_is_larger_for_better_models(matrix):
    evaluator = tuning.AveragePrecision()
    good = LogisticRegression(labelCol="class").fit(training.as_vectors(matrix))
    flat = LogisticRegression(labelCol="class", regParam=100.0, elasticNetParam=1.0).fit(training.as_vectors(matrix))
    data = training.as_vectors(matrix)
    assert evaluator.isLargerBetter()
    assert evaluator.evaluate(good.transform(data)) > evaluator.evaluate(flat.transform(data)) == pytest.approx(0.2)


def test_tuning_picks_the_best_setting(spark, matrix):
    # A forest of depth 0 scores every row alike, so its average precision is the share of positives.
    tuned = tuning.tune_model("random_forest", matrix, key="id", folds=2, search=("grid", {"maxDepth": [0, 3]}))
    assert (tuned.best_params, tuned.strategy) == ({"maxDepth": 3}, "grid")
    assert 0.2 < tuned.best_score <= 1
    summary = tuning.tuning_summary(spark, [tuned]).first()
    assert summary["best_params"] == '{"maxDepth": 3}'
    with pytest.raises(ValueError, match="strategy"):
        tuning.tune_model("random_forest", matrix, key="id", search=("other", {"numTrees": [1]}))


def test_random_search_draws_without_replacement(spark):
    strategy, space = tuning.SEARCHES["gradient_boosted_trees"]
    drawn = tuning.candidates(strategy, space, seed=42, draws=6, spark=spark)
    assert len(drawn) == 6 == len({str(d) for d in drawn})
    assert drawn == tuning.candidates(strategy, space, seed=42, draws=6, spark=spark)
    assert len(tuning.candidates("random", {"a": [1, 2]}, seed=1, draws=6, spark=spark)) == 2


def test_importances(spark, matrix, forest):
    trees = importance.feature_importance(spark, forest.model, NAMES)
    assert trees.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert trees.first()["feature"] == "f1"
    linear = LogisticRegression(labelCol="class").fit(training.as_vectors(matrix))
    table = importance.feature_importance(spark, linear, NAMES)
    up, down = importance.coefficient_extremes(table, top_n=1)
    assert (up.first()["feature"], down.first()["feature"]) == ("f1", "f3")
    assert (up.first()["direction"], down.first()["direction"]) == ("increases_fraud_risk", "decreases_fraud_risk")
    with pytest.raises(ValueError, match="linear"):
        importance.coefficient_extremes(trees)
    bayes = NaiveBayes(labelCol="class", modelType="gaussian").fit(training.as_vectors(matrix))
    with pytest.raises(TypeError):
        importance.feature_importance(spark, bayes, NAMES)


def leaf_expectation(tables, x, known, n_trees):
    """Path-dependent expectation: known features follow the row, others their shares."""
    total = 0.0
    for values, features, lows, highs, shares in tables.values():
        for i, v in enumerate(values):
            for j, f in enumerate(features[i]):
                v *= float(lows[i][j] < x[f] <= highs[i][j]) if f in known else shares[i][j]
            total += v
    return total / n_trees


def test_tree_attribution_is_shapley(matrix, forest):
    values, base = at.tree_attribution(matrix, forest.model, NAMES, key="id")
    phi = {(r["id"], r["feature"]): r["phi"] for r in values.collect()}
    score = {r["id"]: r["score"] for r in forest.scores.collect()}
    for i, s in score.items():
        assert base + sum(phi[i, n] for n in NAMES) == pytest.approx(s, abs=1e-9)
    tables, _, n_trees = at.forest_leaves(forest.model, matrix)
    for row in matrix.where("id < 3").collect():
        for j in range(4):
            others = [f for f in range(4) if f != j]
            want = 0.0
            for size in range(4):
                weight = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                for subset in itertools.combinations(others, size):
                    want += weight * (leaf_expectation(tables, row["features"], {*subset, j}, n_trees)
                                      - leaf_expectation(tables, row["features"], set(subset), n_trees))
            assert phi[row["id"], NAMES[j]] == pytest.approx(want, abs=1e-9)


def test_linear_attribution(matrix):
    means = at.background_means(matrix)
    assert means == pytest.approx(list(np.mean([r["features"] for r in matrix.collect()], axis=0)))
    values = at.linear_attribution(matrix, [1.0, 0.0, -2.0, 3.0], means, NAMES, key="id")
    row = matrix.where("id = 5").first()["features"]
    got = {r["feature"]: r["phi"] for r in values.where("id = 5").collect()}
    assert got == pytest.approx({n: c * (x - m) for n, c, x, m in zip(NAMES, [1.0, 0.0, -2.0, 3.0], row, means, strict=True)})


EIGHT = [f"g{j}" for j in range(8)]


@pytest.fixture(scope="module")
def eight(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        x = [rng.gauss(0, 1) for _ in range(6)] + [float(rng.random() < 0.4), float(rng.random() < 0.2)]
        rows.append((i, int(x[0] + x[1] * x[6] - x[2] + rng.gauss(0, 0.5) > 0.8), x))
    return spark.createDataFrame(rows, "id long, class int, features array<double>").cache()


@pytest.fixture(scope="module")
def boosted(eight):
    return GBTClassifier(maxIter=6, maxDepth=5, stepSize=0.3, seed=1, labelCol="class").fit(training.as_vectors(eight))


def brute_shapley(value, x, background):
    """Shapley values over all subsets, missing features from every background row in turn."""
    width = len(x)
    games = {}
    for bits in range(1 << width):
        on = np.array([bits >> j & 1 == 1 for j in range(width)])
        games[bits] = float(np.mean(value(np.where(on, x, background))))
    phi = np.zeros(width)
    for j in range(width):
        for bits in (b for b in games if not b >> j & 1):
            s = bits.bit_count()
            phi[j] += math.factorial(s) * math.factorial(width - s - 1) / math.factorial(width) * (games[bits | 1 << j] - games[bits])
    return phi, games[0]


def test_boosted_attribution_is_shapley_over_the_whole_background(eight, boosted):
    rows, background = eight.where("id < 4"), eight.where("id >= 200 AND id < 240")
    values, base = at.boosted_attribution(rows, background, boosted, EIGHT, key="id", scale="margin")
    got = {(r["id"], r["feature"]): r["phi"] for r in values.collect()}
    from pyspark.ml.linalg import Vectors
    others = np.array([r["features"] for r in background.collect()])
    seen = {}

    def margins(points):
        for p in map(tuple, points):
            if p not in seen:
                seen[p] = boosted.predictRaw(Vectors.dense(p))[1]
        return [seen[tuple(p)] for p in points]

    for r in rows.where("id < 2").collect():
        want, ground = brute_shapley(margins, np.array(r["features"]), others[:6])
        few, few_base = at.boosted_attribution(rows.where(F.col("id") == r["id"]), background.where("id < 206"), boosted, EIGHT,
                                               key="id", scale="margin")
        phi = {x["feature"]: x["phi"] for x in few.collect()}
        assert few_base == pytest.approx(ground, abs=1e-9)
        assert [phi[n] for n in EIGHT] == pytest.approx(list(want), abs=1e-9)
    for r in rows.collect():
        assert base + sum(got[r["id"], n] for n in EIGHT) == pytest.approx(margins([r["features"]])[0], abs=1e-9)


@pytest.mark.parametrize("kind", ["boosted", "sampled"])
def test_attributions_add_up_to_the_probability(eight, boosted, kind):
    rows, background = eight.where("id < 12"), eight.where("id >= 200 AND id < 230")
    scores = {r["id"]: r["score"] for r in training.score_rows(boosted, eight, name="m", key="id").collect()}
    if kind == "boosted":
        values, base = at.boosted_attribution(rows, background, boosted, EIGHT, key="id")
        assert base == pytest.approx(np.mean([scores[i] for i in range(200, 230)]), abs=1e-9)
    else:
        values = at.sampled_attribution(rows, background, boosted, EIGHT, key="id", permutations=2)
        base = np.mean([scores[i] for i in range(200, 230)])
    assert values.count() == 12 * 8
    for r in values.groupBy("id").agg(F.sum("phi").alias("t")).collect():
        assert base + r["t"] == pytest.approx(scores[r["id"]], abs=1e-9)


def test_sampled_attribution_comes_close_to_shapley(matrix):
    """Drawn orders and their reverses over the whole background, against all subsets."""
    from pyspark.ml.classification import LogisticRegression as Linear
    model = Linear(labelCol="class").fit(training.as_vectors(matrix))
    background = matrix.where("id >= 250 AND id < 265")
    values = at.sampled_attribution(matrix.where("id < 3"), background, model, NAMES, key="id", permutations=24)
    from pyspark.ml.linalg import Vectors
    others = np.array([r["features"] for r in background.collect()])
    for r in matrix.where("id < 3").collect():
        want, _ = brute_shapley(lambda ps: [model.predictProbability(Vectors.dense(p))[1] for p in ps], np.array(r["features"]), others)
        got = {x["feature"]: x["phi"] for x in values.where(F.col("id") == r["id"]).collect()}
        assert [got[n] for n in NAMES] == pytest.approx(list(want), abs=0.03)


def test_equal_rows_get_nothing(eight, boosted):
    rows = eight.where("id = 1")
    values = at.sampled_attribution(rows, rows, boosted, EIGHT, key="id", permutations=1)
    assert [r["phi"] for r in values.collect()] == [0.0] * 8
    exact, _ = at.boosted_attribution(rows, rows, boosted, EIGHT, key="id")
    assert [r["phi"] for r in exact.collect()] == pytest.approx([0.0] * 8)
    with pytest.raises(ValueError, match="background"):
        at.boosted_attribution(rows, rows.where("id < 0"), boosted, EIGHT, key="id")
    with pytest.raises(ValueError, match="scale"):
        at.boosted_attribution(rows, rows, boosted, EIGHT, key="id", scale="odds")


def test_ranking_and_waterfall(spark):
    rows = [(i, f"f{j}", v) for i, vs in enumerate([[0.5, -0.1, 0.2], [0.7, 0.1, -0.2], [0.6, 0.0, -0.1]]) for j, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "id long, feature string, phi double")
    ranked = at.rank_features(df, top_n=2).collect()
    assert [(r["feature"], r["impact_direction"]) for r in ranked] == [
        ("f0", "increases_fraud_risk"), ("f2", "decreases_fraud_risk")]
    bars = at.waterfall(df.where("id = 0"), key="id", bars=2).orderBy("bar").collect()
    assert [(b["feature"], round(b["phi"], 6), b["features"]) for b in bars] == [("f0", 0.5, 1), ("other features", 0.1, 2)]


def test_strongest_case_prefers_fraud(spark):
    df = spark.createDataFrame([(1, 0, 0.9), (2, 1, 0.4), (3, 1, 0.6)], "id long, y int, score double")
    assert at.strongest_case(df, key="id").first()["id"] == 3
    assert at.strongest_case(df.where("y = 0"), key="id").first()["id"] == 1


def test_insight_facts(spark):
    comparison = spark.createDataFrame(
        [("random_forest", 0.9, 0.5, 0.6, 0.7, 0.62, 10, 1, 2, 90), ("logistic_regression", 0.1, 0.6, 0.2, 0.7, 0.38, 12, 90, 1, 0)],
        "model_name string, precision double, recall double, f1 double, roc_auc double, pr_auc double, true_positives long, "
        "false_positives long, false_negatives long, true_negatives long")
    features = spark.createDataFrame([("time_since_signup_hours", 0.69), ("country_US", 0.1), ("source_Direct", 0.05)],
                                     "feature string, importance double")
    row = importance.insight_facts(comparison, features).first()
    assert (row["model_name"], row["holdout_rows"], row["baseline_pr_auc"]) == ("random_forest", 103, 0.38)
    assert (row["top_feature"], row["country_features"], row["direct_channel_in_top"]) == ("time_since_signup_hours", 1, True)


def test_explain_by_model_kind(spark, matrix, forest):
    from txnlens.operators.encoding import FittedEncoder

    encoder = FittedEncoder({n: (0.0, 1.0) for n in NAMES}, {})
    prepared = modeling.PreparedData(matrix.where("id % 3 != 0"), matrix.where("id % 3 = 0"), encoder, "id")
    trained = training.train_model("random_forest", prepared.train, prepared.test, key="id",
                                   estimator=RandomForestClassifier(numTrees=3, maxDepth=3, seed=1, labelCol="class"))
    result = modeling.explain(trained, prepared, background_rows=20, explained_rows=30, top_n=3)
    assert result.explained.count() == 30
    assert result.attributions.count() == 120
    assert result.case.first()["y"] == 1
    assert result.dependence.count() == 30
    total = result.waterfall.agg(F.sum("phi")).first()[0] + result.base
    assert total == pytest.approx(result.case.first()["score"], abs=1e-9)


def test_leaves_add_their_shapley_values_piece_by_piece():
    rng = np.random.default_rng(5)
    m, n_leaves, n_rows, width = 4, 9000, 3, 6
    features = np.stack([rng.choice(width, m, replace=False) for _ in range(n_leaves)])
    lows = np.where(rng.random((n_leaves, m)) < 0.5, -np.inf, rng.normal(size=(n_leaves, m)) - 1)
    highs = np.where(rng.random((n_leaves, m)) < 0.5, np.inf, rng.normal(size=(n_leaves, m)) + 1)
    shares, values = rng.uniform(0.1, 0.9, size=(n_leaves, m)), rng.normal(size=n_leaves)
    x = rng.normal(size=(n_rows, width))
    want = np.zeros((n_rows, width))
    for i in range(n_rows):
        passes = ((x[i][features] > lows) & (x[i][features] <= highs)).astype(float)
        for j in range(m):
            rest = [k for k in range(m) if k != j]
            for size in range(m):
                for camp in itertools.combinations(rest, size):
                    others = np.prod([passes[:, k] if k in camp else shares[:, k] for k in rest], axis=0)
                    share = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                    np.add.at(want[i], features[:, j], share * values * others * (passes[:, j] - shares[:, j]))
    phi = np.zeros((n_rows, width))
    # Several pieces of leaves for so few rows; a piece fits the cache.
    at._add_leaves(phi, x, (values, features, lows, highs, shares))
    assert np.abs(phi - want).max() < 1e-9


def test_rows_look_up_what_leaves_add():
    rng = np.random.default_rng(8)
    width = 9
    x = np.round(rng.normal(size=(700, width)), 1)
    x[0, 0], x[1, 1], x[2, 2] = np.nan, -np.inf, np.inf
    tables = {}
    for m in (1, 2, 5, 9):
        # Neighboring leaves share the first places of their paths.
        features = np.tile(rng.permutation(width)[:m], (40, 1))
        features[20:] = rng.permutation(width)[:m]
        lows = np.where(rng.random((40, m)) < 0.5, -np.inf, np.round(rng.normal(size=(40, m)) - 1, 1))
        highs = np.where(rng.random((40, m)) < 0.5, np.inf, np.round(rng.normal(size=(40, m)) + 1, 1))
        lows[1:10, :m // 2], highs[1:10, :m // 2] = lows[0, :m // 2], highs[0, :m // 2]
        tables[m] = (rng.normal(size=40), features, lows, highs, rng.uniform(0.1, 0.9, size=(40, m)))
    codes, coded = at._codes(x, tables)
    for m, table in tables.items():
        want, got = np.zeros((len(x), width)), np.zeros((width, len(x)))
        at._add_leaves(want, x, table)
        at._add_answers(got, codes, coded[m])
        assert np.abs(want - got.T).max() < 1e-12
        # A leaf answers each set of places once, however many rows there are.
        assert at._leaf_answers(table, slice(0, 3)).shape == (3, m, 1 << m)


def test_rows_gather_before_they_are_explained():
    import pandas as pd
    batches = [pd.DataFrame({"id": range(n)}) for n in (3, 0, 4, 5, 1)]
    assert [len(b) for b in at._larger(iter(batches), 6)] == [7, 6]
    assert [len(b) for b in at._larger(iter(batches[:1]), 6)] == [3] and not [*at._larger(iter([]), 6)]

import numpy as np
import pytest

from txnlens.operators.quantiles import quantile_frame, quantile_values

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def draw(kind, n=6000, seed=5):
    rng = np.random.default_rng(seed)
    if kind == "lognormal":
        return rng.lognormal(0, 4, n)
    if kind == "ties":
        return rng.choice([0.0, 0.0, 0.0, 1.5, 7.0, -3.0], n)
    if kind == "mixed":
        return np.where(rng.random(n) < 0.4, 42.0, rng.normal(0, 1e6, n))
    return rng.random(n)


@pytest.mark.parametrize("kind", ["lognormal", "ties", "mixed", "uniform"])
@pytest.mark.parametrize("exact_rows", [10**6, 20])
def test_equals_numpy(spark, kind, exact_rows):
    values = draw(kind)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(5)
    got = quantile_values(df, ["x"], PROBABILITIES, exact_rows=exact_rows)["x"]
    assert got == pytest.approx(list(np.quantile(values, PROBABILITIES)), rel=1e-12)


@pytest.mark.parametrize("exact_rows", [10**6, 15])
def test_by_class_and_several_columns(spark, exact_rows):
    a, b = draw("lognormal"), draw("mixed")
    classes = np.arange(len(a)) % 3
    df = spark.createDataFrame([(int(c), float(x), float(y)) for c, x, y in zip(classes, a, b, strict=True)],
                               "class int, a double, b double")
    got = {(r["class"], r["column"], r["p"]): r["value"]
           for r in quantile_frame(df, ["a", "b"], [0.25, 0.5], by="class", exact_rows=exact_rows).collect()}
    want = {(c, n, p): float(np.quantile(v[classes == c], p))
            for c in range(3) for n, v in (("a", a), ("b", b)) for p in (0.25, 0.5)}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("n", [201, 997])
def test_refinement_for_many_sizes(spark, seed, n):
    values = draw(["lognormal", "mixed", "ties", "uniform"][seed], n, seed)
    probabilities = [0.003, 0.01, 0.3333, 0.5, 0.9, 0.995]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = quantile_values(df, ["x"], probabilities, exact_rows=1)["x"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantile_values(df, ["x"], [0.5]) == {"x": [None]}


def test_approximate(spark):
    df = spark.range(1001).selectExpr("cast(id AS double) AS x")
    assert abs(quantile_values(df, ["x"], [0.5], approx=10_000)["x"][0] - 500) <= 1


@pytest.mark.parametrize("exact_rows", [10**6, 5])
def test_null_empty_and_missing_groups_stay_apart(spark, exact_rows):
    rows = [(None, float(i)) for i in range(100)] + [("", 1000.0 + i) for i in range(100)] + [("c", None)] * 3
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    got = {r["g"]: r["value"] for r in quantile_frame(df, ["x"], [0.5], by="g", exact_rows=exact_rows).collect()}
    assert got == {None: 49.5, "": 1049.5, "c": None}

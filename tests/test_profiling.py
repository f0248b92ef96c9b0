import math
import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from txnlens.operators import profiling, segments


def test_describe_equals_pandas(spark):
    frame = pd.DataFrame({"amount": [1.0, 2.0, 10.0], "source": ["a", "b", "a"]})
    table = {r["column"]: r for r in profiling.describe(spark.createDataFrame(frame)).collect()}
    want = frame["amount"].describe()
    got = table["amount"]
    assert [got[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(list(want))
    assert (table["source"]["top"], table["source"]["freq"], table["source"]["unique"]) == ("a", 2, 2)


def test_describe_with_gaps(spark):
    df = spark.createDataFrame([(None, None), (float("nan"), None)], "x double, s string")
    table = {r["column"]: r for r in profiling.describe(df).collect()}
    assert (table["x"]["count"], table["x"]["missing"], table["x"]["mean"]) == (0, 2, None)
    assert (table["s"]["count"], table["s"]["top"], table["s"]["freq"]) == (0, None, 0)


def test_missing_summary(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, "x")], "a double, b string")
    assert [(r["column"], r["missing_count"], r["missing_pct"]) for r in profiling.missing_summary(df).collect()] == [
        ("b", 2, 66.67), ("a", 1, 33.33)]


def test_duplicate_check(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20)], "id int, value int")
    assert tuple(profiling.duplicate_check(df).first()) == (2, 1, 33.3333)
    assert tuple(profiling.duplicate_check(df.limit(0)).first()) == (0, 0, 0.0)


@pytest.mark.parametrize(("labels", "counts", "pct", "ratio"), [
    ([0, 0, 0, 1], [3, 1], [75.0, 25.0], 3.0), ([0] * 5 + [1] * 2, [5, 2], [71.4286, 28.5714], 2.5)])
def test_class_balance(spark, labels, counts, pct, ratio):
    table = profiling.class_balance(spark.createDataFrame([(v,) for v in labels], "class int")).orderBy("class").collect()
    assert [r["count"] for r in table] == counts
    assert [r["pct"] for r in table] == pct
    assert {r["imbalance_ratio"] for r in table} == {ratio}


def test_class_balance_single_class_and_missing_target(spark):
    assert profiling.class_balance(spark.createDataFrame([(1,)], "class int")).first()["imbalance_ratio"] is None
    with pytest.raises(ValueError, match="label"):
        profiling.class_balance(spark.range(1), "label")


def test_overview_exact_and_approximate(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, None)], "n int, s string")
    for approx in (False, True):
        got = {r["column"]: (r["non_null"], r["missing"], r["unique"])
               for r in profiling.column_overview(df, approx=approx).collect()}
        assert got == {"n": (2, 1, 2), "s": (2, 1, 1)}


def test_age_bands_show_empty_bands(spark):
    df = spark.createDataFrame([(0, 1), (25, 0), (26, 1), (100, 0), (101, 1)], "age int, class int")
    table = {r["age_band"]: (r["transactions"], r["fraud_rate_pct"]) for r in segments.rate_by_age_band(df).collect()}
    assert table == {"<=25": (2, 50.0), "26-35": (1, 100.0), "36-45": (0, None), "46-55": (0, None),
                     "56+": (1, 0.0), None: (1, 100.0)}


def test_quantile_bands_equal_pandas(spark):
    values = np.random.default_rng(1).integers(0, 50, 500).astype(float)
    df = spark.createDataFrame([(float(v), int(v) % 2) for v in values], "x double, class int")
    got = sorted(r["transactions"] for r in segments.rate_by_quantile_band(df, "x").collect())
    assert got == sorted(pd.qcut(values, 4, duplicates="drop").value_counts().tolist())


def test_quantile_bands_with_equal_edges(spark):
    df = spark.createDataFrame([(0.0, 0)] * 8 + [(1.0, 1), (2.0, 1)], "x double, class int")
    got = {r["band"]: r["transactions"] for r in segments.rate_by_quantile_band(df, "x").collect()}
    want = pd.qcut([0.0] * 8 + [1.0, 2.0], 4, duplicates="drop").value_counts().tolist()
    assert sorted(got.values()) == sorted(n for n in want if n)


def test_histogram_counts_every_row(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 5, 719, 720, 5000]], "x double")
    table = segments.histogram(df, "x", bins=10, low=0.0, high=720.0, cap=720.0)
    assert {r["bin"]: r["count"] for r in table.collect()} == {0: 3, 9: 3}
    assert sum(r["count"] for r in segments.histogram(df, "x", bins=7).collect()) == 6


def test_correlations(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(size=(50, 3)), columns=list("abc"))
    got = {(r["a"], r["b"]): r["r"] for r in segments.correlations(spark.createDataFrame(frame), list("abc")).collect()}
    want = frame.corr()
    assert len(got) == 9
    assert all(got[i, j] == pytest.approx(want.loc[i, j]) for i in "abc" for j in "abc")


def test_mean_rate_drops_null_segments(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "s string, class int")
    assert [tuple(r) for r in segments.mean_rate_by(df, "s").collect()] == [("a", 2, 0.5)]


def test_correlations_of_many_columns(spark):
    from txnlens.operators.correlation import vector_correlations

    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 15)) * 10.0 ** rng.integers(-3, 6, 15) + 1e6
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=500) * 1e-3
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 7.0
    names = [f"c{j}" for j in range(15)]
    frame = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(frame).replace(float("nan"), None).repartition(3)
    got = {(r["a"], r["b"]): r["r"] for r in segments.correlations(df, names).collect()}
    want = frame.corr(min_periods=1)
    assert len(got) == 225
    for (a, b), r in got.items():
        assert (math.isnan(r) and math.isnan(want.loc[a, b])) or r == pytest.approx(want.loc[a, b], abs=1e-7), (a, b)
    assert vector_correlations(df.select(F.array(*names).alias("v")).limit(0), "v").count() == 0
    lonely = spark.createDataFrame([([1.0, None],), ([None, 2.0],)], "v array<double>")
    assert {(r["i"], r["j"]): r["r"] for r in vector_correlations(lonely, "v").where("i != j").collect()} == {(0, 1): None, (1, 0): None}

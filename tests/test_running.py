import random

import pytest
from pyspark.sql import functions as F

from txnlens.operators import running
from txnlens.operators.running import running_sums

SCHEMA = "g string, t int, v long, x double"


def made(n, groups, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(groups), rng.randrange(n // 2 + 1), rng.randrange(-9, 9) if rng.random() > 0.1 else None, rng.random())
            for _ in range(n)]


def brute(rows, reverse=False):
    """Running sums at the last row of every (group, order)."""
    out, sums = {}, {}
    for g, t, v, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1] if reverse else r[1])):
        n, s = sums.get(g, (0, 0))
        sums[g] = out[g, t] = (n + 1, s + (v or 0))
    return out


@pytest.mark.parametrize("groups", [["a"], ["a", "b", None], [f"g{i}" for i in range(300)] + ["hot"] * 150])
@pytest.mark.parametrize("reverse", [False, True])
def test_sums_equal_brute_force(spark, groups, reverse):
    rows = made(3000, groups)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    order = F.col("t").desc() if reverse else F.col("t")
    got = running_sums(df, ["g"], [order], {"n": F.lit(1).cast("long"), "s": F.col("v")}, rows_per_stretch=200)
    assert got.columns == ["g", "t", "v", "x", "n", "s"] and got.count() == len(rows)
    last = {(r.g, r.t): (r.n, r.s) for r in sorted(got.collect(), key=lambda r: r.n)}
    assert last == brute(rows, reverse)
    per_group = got.groupBy("g").agg(F.countDistinct("n").alias("d"), F.count("*").alias("c")).collect()
    assert all(r.d == r.c for r in per_group)


def test_one_group_and_equal_rows_spread_over_stretches(spark, monkeypatch):
    df = spark.range(4000).select(F.lit("one").alias("g"), F.lit(7).alias("t"))
    written = []
    keep = running.materialize
    monkeypatch.setattr(running, "materialize", lambda *a, **b: written.append(keep(*a, **b)) or written[-1])
    got = running_sums(df, ["g"], ["t"], {"n": F.lit(1).cast("long")}, rows_per_stretch=500)
    sizes = [r["count"] for r in written[0].groupBy("__part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1200
    assert sorted(r.n for r in got.select("n").collect()) == list(range(1, 4001))


def test_empty_and_no_group(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert running_sums(df, ["g"], ["t"], {"n": F.lit(1).cast("long")}).count() == 0
    with pytest.raises(ValueError):
        running_sums(df, [], ["t"], {"n": F.lit(1).cast("long")})


@pytest.mark.parametrize("stretch", [60, 100_000])
def test_latest_value_before_the_row(spark, stretch):
    rows = [(f"g{i % 3}" if i % 2 else "hot", i, i if i % 5 == 0 and i > 40 else None, 0.0) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = running_sums(df, ["g"], ["t"], {"n": F.lit(1).cast("long")}, latest={"last": F.col("v")}, rows_per_stretch=stretch)
    seen, want = {}, {}
    for g, t, v, _ in rows:
        want[t] = seen.get(g)
        seen[g] = v if v is not None else seen.get(g)
    assert {r.t: r["last"] for r in got.collect()} == want

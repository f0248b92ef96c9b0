import math
import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from txnlens.operators import sampling, smote


def digest(seed, key):
    return hashlib.md5(f"{seed}-{key}".encode()).hexdigest()


def labelled(spark, sizes):
    return spark.createDataFrame([(i, c) for i, c in enumerate(c for c, n in sizes.items() for _ in range(n))],
                                 "id long, class int").repartition(3)


def test_published_split_sizes():
    counts = sampling.train_counts({0: 136_961, 1: 14_151}, 0.2)
    assert counts == {0: 109_568, 1: 11_321}


def test_split_is_exact_disjoint_and_complete(spark):
    df = labelled(spark, {0: 901, 1: 97})
    train, test = sampling.stratified_split(df, key="id")
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not a & b and len(a | b) == 998 and len(b) == 200
    assert sampling.class_sizes(train, "class") == sampling.train_counts({0: 901, 1: 97}, 0.2)
    again = {r["id"] for r in sampling.stratified_split(df.repartition(1), key="id")[0].collect()}
    assert a == again


def test_sample_takes_the_smallest_digests(spark):
    df = spark.range(3000)
    got = {r["id"] for r in sampling.seeded_sample(df, 700, key="id", seed=3).collect()}
    assert got == set(sorted(range(3000), key=lambda i: digest(3, i))[:700])
    assert sampling.seeded_sample(df, 9000, key="id").count() == 3000
    assert sampling.seeded_sample(df, 0, key="id").count() == 0


def test_undersample_balances(spark):
    df = labelled(spark, {0: 500, 1: 40, 2: 77})
    assert sampling.class_sizes(sampling.undersample(df, key="id"), "class") == {0: 40, 1: 40, 2: 40}


def test_folds_are_even(spark):
    df = sampling.with_folds(labelled(spark, {0: 100, 1: 11}), key="id", folds=3)
    counts = {(r["class"], r["fold"]): r["count"] for r in df.groupBy("class", "fold").count().collect()}
    assert sorted(counts[0, f] for f in range(3)) == [33, 33, 34]
    assert sorted(counts[1, f] for f in range(3)) == [3, 4, 4]


def test_counts_are_exact_where_keys_repeat_or_are_missing(spark):
    rows = [(7, c, f"r{i % 40}") for c, n in ((0, 300), (1, 60)) for i in range(n)] + [(None, i % 2, "n") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, class int, note string").repartition(5)
    sizes = {0: 325, 1: 85}
    train, test = sampling.stratified_split(df, key="id")
    assert sampling.class_sizes(train, "class") == sampling.train_counts(sizes, 0.2) and train.count() + test.count() == 410
    assert sorted(map(repr, train.unionByName(test).collect())) == sorted(map(repr, df.collect()))
    again = sampling.stratified_split(df.repartition(2), key="id")[0]
    assert sorted(map(repr, again.collect())) == sorted(map(repr, train.collect()))
    assert sampling.seeded_sample(df, 123, key="id").count() == 123
    assert sampling.class_sizes(sampling.undersample(df, key="id"), "class") == {0: 85, 1: 85}
    folds = sampling.with_folds(df, key="id", folds=4)
    assert folds.columns == ["id", "class", "note", "fold"]
    counts = {(r["class"], r["fold"]): r["count"] for r in folds.groupBy("class", "fold").count().collect()}
    assert all(abs(n - sizes[c] / 4) < 1 for (c, _), n in counts.items()) and len(counts) == 8


def test_dense_index_follows_digest_order(spark):
    got = {r["id"]: r["row_index"] for r in sampling.dense_index(spark.range(500), key="id", seed="s").collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda p: p[1])] == sorted(range(500), key=lambda i: digest("s", i))
    assert sorted(got.values()) == list(range(500))


def test_class_weights(spark):
    assert sampling.class_weights(labelled(spark, {0: 30, 1: 10})) == pytest.approx({0: 40 / 60, 1: 2.0})


def brute_neighbors(points, k):
    out = {}
    for i, v in points.items():
        near = sorted((round(float(np.linalg.norm(np.array(v) - np.array(w))), 6), j) for j, w in points.items() if j != i)
        out[i] = [(j, d) for d, j in near[:k]]
    return out


@pytest.mark.parametrize("block_rows", [1000, 25])
@pytest.mark.parametrize("copies", [0, 60])
def test_neighbors_are_exact(spark, block_rows, copies):
    rng = random.Random(9)
    points = {i: [round(rng.gauss(5 * (i % 4), 1), 2) for _ in range(3)] for i in range(150)}
    points.update({1000 + i: points[7] for i in range(copies)})
    df = spark.createDataFrame(list(points.items()), "id long, features array<double>").repartition(4)
    got = {}
    for r in smote.nearest_neighbors(df, key="id", k=4, block_rows=block_rows).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["neighbor"], r["distance"])
    want = brute_neighbors(points, 4)
    assert {i: [n[r] for r in sorted(n)] for i, n in got.items()} == want


def test_cells_are_bounded_and_rows_are_copied_by_the_root_of_their_number(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(4000, 3)))]
    points = spark.createDataFrame(rows, "rep long, v array<double>").repartition(4)
    cells = smote.pivot_cells(points, 60)
    sizes = [r["count"] for r in cells.groupBy("cell").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 60 and len(sizes) >= 4000 / 60
    # Unbounded reach: every tile meets every tile, and still no row is copied more often than there are tiles.
    rows_, tiles = smote.tile_plan(cells.withColumn("far", F.lit(float("inf"))), 4000, 60)
    n_tiles = rows_.select("tile").distinct().count()
    assert tiles.count() == n_tiles ** 2 and n_tiles <= 2 * math.ceil(math.sqrt(len(sizes)))
    assert rows_.join(tiles, "tile").groupBy("rep").count().agg(F.max("count")).first()[0] == n_tiles
    # A short reach: tiles far apart do not meet.
    line = spark.range(4000).select(F.col("id").alias("rep"), F.array(F.col("id").cast("double")).alias("v"))
    rows_, near = smote.tile_plan(smote.pivot_cells(line, 60).withColumn("far", F.lit(5.0)), 4000, 60)
    assert near.count() < 0.5 * rows_.select("tile").distinct().count() ** 2


def test_cells_beyond_the_deepest_deal(spark, monkeypatch):
    monkeypatch.setattr(smote, "DEEPEST", 1)
    points = spark.createDataFrame([(i, [float(i)]) for i in range(900)], "rep long, v array<double>")
    sizes = [r["count"] for r in smote.pivot_cells(points, 20).groupBy("cell").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 30
    got = {r["id"]: r["neighbor"] for r in smote.nearest_neighbors(
        points.toDF("id", "features"), key="id", k=1, block_rows=20).collect()}
    assert got == {i: i - 1 if i else 1 for i in range(900)}


def test_products_find_what_plain_distances_find(monkeypatch):
    rng = np.random.default_rng(11)
    far_off = rng.integers(0, 4, size=(900, 5)) + 1e6 + np.round(rng.normal(size=(900, 5)), 1) * (rng.random((900, 1)) < 0.5)
    left = pd.DataFrame({"rep": np.arange(300) * 3, "v": list(far_off[:300]), "cell": [f"c{i % 7}" for i in range(300)]})
    right = pd.DataFrame({"rep": np.arange(600)[::-1] * 3 + 1, "v": list(far_off[300:]), "cell": [f"c{i % 9}" for i in range(600)]})
    left["far"] = np.where(left["rep"] % 2 == 0, np.inf, 2.0)

    def rows(table):
        return sorted(zip(table["rep"].astype(int), table["distance"], table["other"].astype(int), strict=True))

    want = {}
    distances = smote._distances(far_off[:300], far_off[300:])
    for i in range(300):
        met = [(distances[i, j], int(right["rep"][j])) for j in range(600)
               if right["cell"][j] != left["cell"][i] and distances[i, j] <= left["far"][i]]
        want.update({(int(left["rep"][i]), d, r): True for d, r in sorted(met)[:6]})
    # No table of all distances is made for finite vectors.
    monkeypatch.setattr(smote, "_distances", None)
    monkeypatch.setattr(smote, "PRODUCT_CELLS", 5000)
    assert rows(smote._search_all(left, right, 6)) == sorted(want)
    inside = smote._closest(right, right, 4)
    assert len(inside) == 2400 and (inside.groupby("rep")["distance"].min() == 0).all()


def test_smote_fills_up_the_minority_on_segments(spark):
    rng = random.Random(4)
    data = [(i, int(i >= 90), [rng.gauss(0, 1), rng.gauss(2 * (i >= 90), 1)]) for i in range(100)]
    df = spark.createDataFrame(data, "id long, class int, features array<double>")
    made = smote.smote_rows(df, key="id").collect()
    points = {i: v for i, _, v in data}
    assert len(made) == 80
    for r in made:
        assert 90 <= r["base"] < 100 and 90 <= r["neighbor"] < 100 and r["base"] != r["neighbor"]
        a, b = points[r["base"]], points[r["neighbor"]]
        assert list(r["features"]) == pytest.approx([x + r["share"] * (y - x) for x, y in zip(a, b, strict=True)])
    balanced = smote.resample(df, "smote", key="id")
    assert sampling.class_sizes(balanced, "class") == {0: 90, 1: 90}
    assert sampling.class_sizes(smote.resample(df, "undersample", key="id"), "class") == {0: 10, 1: 10}
    with pytest.raises(ValueError, match="strategy"):
        smote.resample(df, "other", key="id")


def test_smote_with_two_minority_rows(spark):
    df = spark.createDataFrame([(i, int(i > 7), [float(i)]) for i in range(10)], "id long, class int, features array<double>")
    assert smote.smote_rows(df, key="id").count() == 6


def test_flags_make_cells_and_rule_them_out(spark, monkeypatch):
    rng = np.random.default_rng(6)
    n = 1200
    flags = np.stack([rng.random(n) < 0.5, rng.random(n) < 0.3, rng.random(n) < 0.02], axis=1).astype(float)
    x = np.concatenate([np.round(rng.normal(size=(n, 2)) * 0.3, 2), flags, np.ones((n, 1))], axis=1)
    points = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "rep long, v array<double>").repartition(4)
    cells = smote.pivot_cells(points, 600)
    # The two flags that tell most rows apart; the third one would leave too few rows a pattern, a constant is none.
    monkeypatch.setattr(smote, "FLAGGED_ROWS", 250)
    assert smote.pivot_cells(points, 1200).select("cell").distinct().count() == 4
    assert all(r["low"][2:4] == r["high"][2:4] for r in cells.withColumn("far", F.lit(0.0)).groupBy("cell").applyInPandas(
        smote._cell_stats, smote.CELL_STATS).collect())
    measured = 0
    plain = np.column_stack

    def counted(columns):
        nonlocal measured
        measured += len(columns[0])
        return plain(columns)

    table = pd.DataFrame([(r["rep"], np.array(r["v"]), r["cell"], np.inf) for r in cells.collect()], columns=["rep", "v", "cell", "far"])
    monkeypatch.setattr(smote.np, "column_stack", counted)
    near = smote._search_all(table, table, 4, True)
    want = brute_neighbors({i: v for i, v in enumerate(x)}, 4)
    got = {i: [(int(o), d) for o, d in zip(g["other"], g["distance"], strict=True)] for i, g in near.groupby("rep")}
    assert all(g[0][1] == 0 and [d for _, d in g[1:]] == pytest.approx([d for _, d in want[i][:3]]) for i, g in got.items()) and len(got) == n
    # Cells whose flags differ lie farther apart than the neighbors of nearly all rows, so they are not measured for these.
    assert measured < 4 * n

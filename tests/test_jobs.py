import datetime as dt
import random

import pytest

from txnlens.operators import encoding
from txnlens.operators.encoding import FeatureConfig, fit_encoder
from txnlens.plans import modeling, preparation
from txnlens.sources import readers, saved, standins, writers


@pytest.fixture(scope="module")
def raw_folder(tmp_path_factory):
    folder, rng = tmp_path_factory.mktemp("raw"), random.Random(1)
    start = dt.datetime(2015, 1, 1)
    lines = ["user_id,signup_time,purchase_time,purchase_value,device_id,source,browser,sex,age,ip_address,class"]
    for i in range(300):
        signup = start + dt.timedelta(hours=rng.randrange(2000))
        bought = signup + dt.timedelta(seconds=1 if i % 6 == 0 else rng.randrange(10**6))
        lines.append(f"{i},{signup},{bought},{rng.randrange(100)},D{i % 40},{rng.choice(['SEO', 'Ads', 'Direct'])},"
                     f"{rng.choice(['Chrome', 'IE'])},{rng.choice('MF')},{18 + i % 40},{16777216 + i}.25,{int(i % 6 == 0)}")
    lines.append(lines[1])
    (folder / readers.TRANSACTIONS_FILE).write_text("\n".join(lines) + "\n")
    (folder / readers.IP_RANGES_FILE).write_text(
        "lower_bound_ip_address,upper_bound_ip_address,country\n16777216.0,16777300,Australia\n16777301.0,16777400, China\n")
    (folder / readers.CARDS_FILE).write_text(
        "Time," + ",".join(f"V{i}" for i in range(1, 29)) + ",Amount,Class\n" + ",".join(["0.5"] * 30) + ",1\n")
    return str(folder)


def test_readers(spark, raw_folder, tmp_path):
    assert readers.read_transactions(spark, raw_folder).count() == 301
    assert readers.read_cards(spark, raw_folder).first()["Class"] == 1
    assert readers.read_ip_ranges(spark, raw_folder).first()["country"] == "Australia"
    assert dict(readers.read_transactions(spark, raw_folder, ip_as_text=True).dtypes)["ip_address"] == "string"
    with pytest.raises(FileNotFoundError):
        readers.read_cards(spark, str(tmp_path))
    assert readers.read_optional(spark, f"{tmp_path}/none") is None


def test_read_or_build(spark, tmp_path):
    path = f"{tmp_path}/t"
    built = readers.read_or_build(spark, path, lambda: spark.range(3), required=["id"])
    assert built.count() == 3
    spark.range(5).write.parquet(path)
    assert readers.read_or_build(spark, path, lambda: spark.range(3)).count() == 5
    with pytest.raises(ValueError, match="class"):
        readers.read_or_build(spark, path, lambda: spark.range(3), required=["class"])


def test_first_existing_folder(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/b/metrics")
    folders = [f"{tmp_path}/a", f"{tmp_path}/b"]
    assert readers.first_existing(spark, folders, "metrics") == folders[1]
    assert readers.first_existing(spark, folders, "other") == folders[0]
    assert readers.read_result_tables(spark, folders, ["metrics"])["metrics"].count() == 2


def test_writers(spark, tmp_path):
    table = spark.createDataFrame([("b", 0.2), ("a", 0.5)], "feature string, importance double")
    path = writers.write_top_features(table, str(tmp_path), model_name="Random Forest", top_n=1, format="csv")
    assert path.endswith("top_features_random_forest")
    assert readers.read_table(spark, path, format="csv").first()["feature"] == "a"


def test_geolocation_job(spark, raw_folder, tmp_path):
    saved, rates, path = preparation.geolocation_job(spark, raw_folder, str(tmp_path), min_transactions=10)
    assert saved.count() == 300
    counts = {r["country"]: r["transactions"] for r in rates.collect()}
    assert counts == {"Australia": 85, "China": 100, "unknown": 115}
    assert readers.read_table(spark, path).count() == 300


def test_feature_job(spark, raw_folder, tmp_path):
    paths = preparation.feature_job(spark, raw_folder, str(tmp_path))
    engineered, features = (readers.read_table(spark, paths[n]) for n in ("engineered", "features"))
    assert len(engineered.columns) == 22
    assert features.count() == 300 and "country_China" in features.columns and "class" in features.columns


def test_cleaning_job(spark, raw_folder, tmp_path):
    paths = preparation.cleaning_job(spark, raw_folder, str(tmp_path))
    counts = {n: readers.read_table(spark, p).count() for n, p in paths.items()}
    assert counts == {"fraud_data_cleaned": 300, "creditcard_cleaned": 1, "ip_country_cleaned": 2}


def test_country_is_left_out_without_ranges(spark, raw_folder, tmp_path):
    (tmp_path / readers.TRANSACTIONS_FILE).write_text(open(f"{raw_folder}/{readers.TRANSACTIONS_FILE}").read())
    assert "country" not in preparation.load_base(spark, str(tmp_path)).columns
    assert "country" not in preparation.load_base(spark, raw_folder, include_country=False).columns


def test_history_feeds_velocity(spark):
    when = dt.datetime(2024, 1, 1)
    schema = "event_id long, user_id long, signup_time timestamp_ntz, purchase_time timestamp_ntz"
    past = spark.createDataFrame([(1, 1, when, when)], schema)
    new = spark.createDataFrame([(2, 1, when, when + dt.timedelta(hours=2))], schema)
    alone = preparation.engineer(new).first()
    known = preparation.engineer(new, history=past)
    assert known.count() == 1
    assert (alone["txn_count_last_24h"], known.first()["txn_count_last_24h"]) == (1, 2)
    assert known.first()["hours_since_last_txn"] == 2.0


def test_encoder(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, "a", 0), (2, 3.0, 5.0, "b", 1)], "id long, x double, k double, c string, class int")
    encoder = fit_encoder(df, FeatureConfig(numeric=("x", "k", "absent"), categorical=("c",)))
    assert encoder.names == ["x", "k", "c_a", "c_b"]
    wide = encoder.wide(df, keep=["id"]).orderBy("id").collect()
    assert [tuple(r) for r in wide] == [(1, 0, -1.0, 0.0, 1.0, 0.0), (2, 1, 1.0, 0.0, 0.0, 1.0)]
    unseen = spark.createDataFrame([(1.0, 9.0, "z"), (1.0, 9.0, None)], "x double, k double, c string")
    for row in encoder.vectors(unseen).collect():
        assert list(row["features"]) == [-1.0, 4.0, 0.0, 0.0]
    assert encoder.feature_table(df).count() == 4
    with pytest.raises(ValueError, match="numeric"):
        fit_encoder(df, FeatureConfig(numeric=("q",)))
    with pytest.raises(ValueError, match="categorical"):
        fit_encoder(df, FeatureConfig(numeric=("x",), categorical=("q",)))


@pytest.mark.parametrize("joins", ["broadcast", "hot and cold"])
def test_sparse_encoder_equals_the_dense_one(spark, joins, monkeypatch):
    rows = [(i, float(i % 7) if i % 11 else None, "hot" if i % 3 else f"v{i % 50}", None if i % 5 == 0 else f"k{i % 4}", i % 2) for i in range(300)]
    schema = "id long, x double, c string, d string, class int"
    df, config = spark.createDataFrame(rows, schema), FeatureConfig(numeric=("x",), categorical=("c", "d"))
    if joins != "broadcast":
        monkeypatch.setattr(encoding, "BROADCAST_CATEGORIES", 3)
        monkeypatch.setattr(encoding, "HOT_ROWS", 50)
        monkeypatch.setattr(encoding, "HOT_SHARE", 10)
    dense, sparse = fit_encoder(df, config), encoding.fit_sparse_encoder(df, config)
    assert sparse.width == len(dense.names)
    assert [r["feature"] for r in sparse.feature_table().orderBy("position").collect()] == dense.names
    later = df.unionByName(spark.createDataFrame([(1000, 1.0, "new", None, 1), (1001, None, None, "k1", 0)], schema))
    want = {r["id"]: list(r)[2:] for r in dense.wide(later, keep=["id"]).collect()}
    got = {r["id"]: r["features"] for r in sparse.vectors(later, keep=["id"]).collect()}
    assert got.keys() == want.keys()
    for i, v in got.items():
        assert list(v.toArray()) == pytest.approx([x or 0.0 for x in want[i]]) and (v.indices == sorted(v.indices)).all()
    cells = sparse.long(later, keep=["id"])
    assert cells.where("value = 0").count() == 0 and cells.count() == sum(1 for v in want.values() for x in v if x)
    from pyspark.ml.classification import LogisticRegression
    assert LogisticRegression(labelCol="class", maxIter=3).fit(sparse.vectors(df)).numFeatures == sparse.width
    monkeypatch.setattr(encoding, "MOST_COLUMNS", 10)
    with pytest.raises(ValueError, match="sparse"):
        fit_encoder(df, config)


def test_saved_matrix(spark, tmp_path, monkeypatch):
    rows = [(i, float(i % 7), "ab"[i % 2], i % 2) for i in range(40)]
    df, config = spark.createDataFrame(rows, "event_id long, x double, c string, class int"), FeatureConfig(numeric=("x",), categorical=("c",))
    place = str(tmp_path / "matrix")
    assert saved.load_matrix(spark, place) is None
    built = saved.load_or_build_matrix(spark, place, lambda: df, config=config)
    again = saved.load_or_build_matrix(spark, place, lambda: 1 / 0, config=config)
    assert (again.encoder, again.classes) == (built.encoder, {"0": 20, "1": 20})
    assert sorted(again.matrix.collect()) == sorted(built.encoder.wide(df, keep=["event_id"]).collect())
    # A later save is what readers get; one that breaks off, or whose target is wrong, is not seen.
    newer = saved.save_matrix(built.encoder.wide(df.limit(30), keep=["event_id"]), built.encoder, place)
    with pytest.raises(ValueError, match="target"):
        saved.save_matrix(built.encoder.wide(df.where("class = 1"), keep=["event_id"]), built.encoder, place)
    (tmp_path / "matrix" / "manifests" / "99999999-broken").mkdir()
    assert saved.load_matrix(spark, place).classes == newer.classes
    with pytest.raises(ValueError, match="x"):
        saved.save_matrix(df.select("event_id", "class"), built.encoder, place)
    # A matrix that lost rows no longer fits its manifest.
    newer.matrix.limit(3).write.mode("overwrite").parquet(str(tmp_path / "fewer"))
    monkeypatch.setattr(saved.json, "loads", lambda t, keep=saved.json.loads: keep(t) | {"path": str(tmp_path / "fewer")})
    with pytest.raises(ValueError, match="manifest"):
        saved.load_matrix(spark, place)


def test_modeling_job(spark, raw_folder, tmp_path):
    engineered = preparation.engineer(preparation.load_base(spark, raw_folder), order_key="user_id")
    result = modeling.run_modeling(
        engineered, models=["logistic_regression", "random_forest"], key="user_id", folds=2, report_folder=str(tmp_path),
        searches={"logistic_regression": ("grid", {"C": [1.0]}), "random_forest": ("grid", {"numTrees": [5], "maxDepth": [4]})})
    balance = {(r["stage"], r["class"]): r["count"] for r in result.data.balance.collect()}
    assert balance["train_after_resampling", 0] == balance["train_after_resampling", 1] == 200
    assert balance["test_holdout_unmodified", 0] + balance["test_holdout_unmodified", 1] == 60
    assert result.comparison.first()["model_name"] == result.best.name
    tables = readers.read_result_tables(
        spark, [str(tmp_path)], ["model_comparison_metrics", "best_model_summary", "class_imbalance_comparison",
                                 "tuning_summary", "top_features_best_model"])
    assert {n: t.count() for n, t in tables.items() if n != "top_features_best_model"} == {
        "model_comparison_metrics": 2, "best_model_summary": 1, "class_imbalance_comparison": 6, "tuning_summary": 2}
    assert tables["top_features_best_model"].count() <= 20
    found = modeling.attribution_job(engineered, f"{tmp_path}/shap", result=result, background_rows=30, explained_rows=20)
    saved = readers.read_table(spark, f"{tmp_path}/shap/shap_top_features")
    assert saved.count() == found.top_features.count() == 10
    assert readers.read_table(spark, f"{tmp_path}/shap/shap_beeswarm").count() == found.beeswarm.count() > 0
    # Without its rows the model is explained on the same split, made again.
    alone = modeling.attribution_job(engineered, f"{tmp_path}/again", model=result.best, key="user_id", background_rows=30, explained_rows=20)
    assert sorted(alone.explained.collect()) == sorted(found.explained.collect()) and alone.base == pytest.approx(found.base)


def test_resampling_job(spark, raw_folder, tmp_path):
    engineered = preparation.engineer(preparation.load_base(spark, raw_folder, include_country=False), order_key="user_id")
    data = modeling.resampling_job(engineered, str(tmp_path), strategy="undersample", key="user_id")
    assert data.train_resampled.count() == 80
    assert readers.read_table(spark, f"{tmp_path}/class_imbalance_comparison").count() == 6


def test_standins_have_their_traps(spark, small_folder):
    dirty = standins.dirty_transactions(spark, small_folder)
    base = standins.transactions(spark, small_folder)
    assert dirty.count() > base.count() and dirty.where("signup_time = 'not-a-time'").count() > 0

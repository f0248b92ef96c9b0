import datetime as dt

import pytest
from pyspark.sql import functions as F

from txnlens.functions import checks, clock, labels, numbers, seeded
from txnlens.operators.columns import (
    comparison_columns, metrics_long, snake_columns, snake_name, split_target, stack_rows)
from txnlens.operators.geolocation import add_ip_integer
from txnlens.operators.temporal import add_purchase_clock, add_time_since_signup


def test_ip_from_numbers(spark):
    values = [732758368.79972, 0.0, 4294967295.0, 4294967295.5, -0.5, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "ip_address double")
    got = [r[0] for r in add_ip_integer(df).select("ip_address_int").collect()]
    assert got == [732758368, 0, 4294967295, None, None, None, None]


def test_ip_from_text(spark):
    values = ["192.168.0.1", None, "not-an-ip", "", "192.168.00.1", "300.1.1.1", "255.255.255.255", "123456", "1.2.3"]
    df = spark.createDataFrame([(v,) for v in values], "ip_address string")
    got = [r[0] for r in add_ip_integer(df).select("ip_address_int").collect()]
    assert got == [3232235521, None, None, None, None, None, 4294967295, None, None]


def test_clock_is_independent_of_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:30:00' AS signup_time, "
                       "timestamp_ntz'2024-03-10 03:30:00' AS purchase_time")
        # 02:30 does not exist on a New York clock that day.
        gap = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.000001' AS t, timestamp_ntz'1969-12-31 23:59:59.5' AS u")
        micros = tuple(gap.select(clock.epoch_micros(F.col("t")), clock.epoch_micros(F.col("u"))).first())
        row = add_purchase_clock(add_time_since_signup(df)).first()
        parsed = spark.range(1).select(clock.parse_time(F.lit("2024-03-10 02:30:05"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row["time_since_signup_hours"], row["hour_of_day"], row["day_of_week"]) == (2.0, 3, 6)
    assert parsed == dt.datetime(2024, 3, 10, 2, 30, 5)
    assert micros == (1_710_037_800_000_001, -500_000)


def test_parse_time_rejects_other_formats(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-01T00:00:00",), ("2024-02-30 00:00:00",), ("x",)], "t string")
    assert [r[0] for r in df.select(clock.parse_time(F.col("t"))).collect()] == [None] * 4


def test_times_need_their_columns(spark):
    with pytest.raises(ValueError, match="signup_time"):
        add_time_since_signup(spark.range(1))


def test_ratio_and_clip(spark):
    row = spark.range(1).select(
        numbers.ratio(F.lit(1), F.lit(0)), numbers.ratio_or_zero(F.lit(1), F.lit(0)),
        numbers.clip(F.lit(5.0), upper=3.0), numbers.clip(F.lit(None).cast("double"), lower=1.0)).first()
    assert tuple(row) == (None, 0.0, 3.0, None)


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert df.where(checks.is_missing(df, "x")).count() == 2
    assert checks.nan_to_null(df).where("x IS NULL").count() == 2


def test_feature_labels(spark):
    names = ["country_United_States", "browser_IE", "source_Direct", "sex_M", "age", "txn_count_last_24h", "some_thing"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [tuple(r) for r in df.select(labels.feature_text(F.col("f")), labels.feature_category(F.col("f"))).collect()]
    assert got == [
        ("transactions from United States", "geography"), ("using IE browser", "device_browser"),
        ("traffic from Direct channel", "acquisition_channel"), ("customer sex = M", "other"),
        ("customer age", "behavioral_timing"), ("many transactions in the last 24 hours", "other"),
        ("some thing", "other")]


def test_seeded_values_do_not_depend_on_partitions(spark):
    one = spark.range(100).repartition(1).select("id", seeded.seeded_uniform(1, F.col("id")).alias("u"))
    many = spark.range(100).repartition(7).select("id", seeded.seeded_uniform(1, F.col("id")).alias("u"))
    assert sorted(one.collect()) == sorted(many.collect())
    assert one.where("u < 0 OR u >= 1").count() == 0


@pytest.mark.parametrize(("raw", "want"), [
    ("Purchase Time", "purchase_time"), ("Class", "class"), ("V-1", "v1"), ("Amount ($)", "amount_"), ("userID", "userid")])
def test_snake_name(raw, want):
    assert snake_name(raw) == want


def test_snake_columns_reject_clashes(spark):
    with pytest.raises(ValueError, match="share a name"):
        snake_columns(spark.range(1).selectExpr("id AS `A b`", "id AS `a  B`"))


def test_split_target(spark):
    df = spark.createDataFrame([(1, 0)], "x int, class int")
    features, target = split_target(df, "class")
    assert (features.columns, target.columns) == (["x"], ["class"])
    with pytest.raises(ValueError, match="label"):
        split_target(df, "label")


def test_comparison_columns_and_unpivot(spark):
    df = spark.createDataFrame([("m", 0.5, 0.25, 9)], "model_name string, auc_pr double, f1 double, extra int")
    table = comparison_columns(df)
    assert table.columns == ["model_name", "f1", "pr_auc"]
    assert metrics_long(table, ["f1", "pr_auc"]).count() == 2


def test_stack_rows_fills_absent_columns(spark):
    stacked = stack_rows([spark.range(1).selectExpr("id AS a"), spark.range(1).selectExpr("id AS b")])
    assert sorted(stacked.collect(), key=repr) == sorted([(0, None), (None, 0)], key=repr)


def test_picks_reach_beyond_32_bits(spark):
    picks = [r[0] for r in spark.range(200).select(seeded.seeded_pick(F.lit(2**50), 1, F.col("id"))).collect()]
    assert max(picks) > 2**48 and min(picks) >= 0 and len(set(picks)) == 200


def test_null_keys_have_a_digest(spark):
    row = spark.range(1).select(seeded.seeded_digest(1, F.lit(None)).alias("a"), seeded.seeded_digest(1, F.lit("")).alias("b")).first()
    assert row["a"] and row["a"] != row["b"]


def test_scratch_is_deleted(spark):
    from txnlens.session import materialize, scratch

    with scratch(spark):
        table = materialize(spark.range(3), "gone")
        path = table.inputFiles()[0]
        assert table.count() == 3
    import os
    from urllib.parse import urlparse

    assert not os.path.exists(urlparse(path).path)

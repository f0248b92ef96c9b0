import datetime as dt

import pytest

from txnlens.operators import cleaning
from txnlens.plans.preparation import clean_cards, clean_ip_ranges, clean_transactions

RAW = ("user_id long, signup_time string, purchase_time string, purchase_value double, device_id string, source string, "
       "browser string, sex string, age long, ip_address double, class long")


def test_median_and_unknown(spark):
    df = spark.createDataFrame([(20.0, "Chrome"), (None, None), (30.0, "Safari")], "age double, browser string")
    filled = cleaning.fill_missing(df, string_fill="unknown").collect()
    assert (filled[1]["age"], filled[1]["browser"]) == (25.0, "unknown")


def test_whole_number_column_with_fractional_fill(spark):
    df = spark.createDataFrame([(20, 1), (None, None), (31, 3)], "age long, n long")
    row = cleaning.fill_missing(df).collect()[1]
    assert (row["age"], row["n"]) == (25.5, 2)
    assert cleaning.fill_missing(df).schema["n"].dataType.simpleString() == "bigint"


def test_mode_tie_takes_the_smallest_and_all_null_is_unknown(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    row = cleaning.fill_missing(df).collect()[2]
    assert (row["x"], row["y"]) == ("a", "unknown")


def test_fill_uses_rows_left_after_the_drop(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (100.0, None)], "x double, class int")
    assert sorted(r["x"] for r in cleaning.fill_missing(df, required=["class"]).collect()) == [1.0, 1.0]


def test_nan_is_filled(spark):
    df = spark.createDataFrame([(float("nan"),), (4.0,)], "x double")
    assert [r["x"] for r in cleaning.fill_missing(df, numeric_fill="mean").collect()] == [4.0, 4.0]


def test_times_are_never_filled(spark):
    df = spark.sql("SELECT cast(null AS timestamp_ntz) AS t, 1 AS x")
    assert cleaning.fill_missing(df).first()["t"] is None


@pytest.mark.parametrize("bad", [{"numeric_fill": "mode"}, {"string_fill": "median"}, {"required": ["nope"]}])
def test_bad_arguments(spark, bad):
    with pytest.raises(ValueError):
        cleaning.fill_missing(spark.range(1), **bad)


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20)], "id int, value int")
    assert rows(cleaning.drop_duplicates(df)) == [(1, 10), (2, 20)]
    assert rows(cleaning.drop_duplicates(df, keep=False)) == [(2, 20)]


def test_duplicates_by_subset(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id int, v string")
    keep = {k: rows(cleaning.drop_duplicates(df, subset=["id"], keep=k, order_by=["v"])) for k in ("first", "last", False)}
    assert keep["first"] == [(1, "a"), (2, "c"), (None, "d")]
    assert keep["last"] == [(1, "b"), (2, "c"), (None, "e")]
    assert keep[False] == [(2, "c")]
    with pytest.raises(ValueError, match="order_by"):
        cleaning.drop_duplicates(df, subset=["id"])


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id")
    plan = cleaning.drop_duplicates(df, subset=["k"], order_by=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("bad",), (None,)], "t string")
    assert [r["t"] for r in cleaning.parse_timestamps(df, ["t"]).collect()] == [dt.datetime(2024, 1, 1, 10), None, None]
    assert cleaning.unparsed_counts(df, ["t"]).first()["invalid"] == 1
    with pytest.raises(Exception, match="not a time"):
        cleaning.parse_timestamps(df, ["t"], errors="raise").collect()
    with pytest.raises(ValueError):
        cleaning.parse_timestamps(df, ["u"])


def test_transaction_job(spark):
    good = (1, "2024-01-01 00:00:00", "2024-01-01 01:00:00", 10.0, "D1", "SEO", None, "M", 30, 16777216.5, 0)
    raw = [good, good, (2, None, "2024-01-01 01:00:00", 1.0, "D2", "Ads", "IE", "F", 20, 1.0, 1),
           (3, "2024-01-02 00:00:00", None, 1.0, "D3", "Ads", "IE", "F", 20, 1.0, 1),
           (4, "2024-01-03 00:00:00", "2024-01-03 03:00:00", None, "D4", "Ads", "IE", "F", None, 2.0, 1)]
    table = {r["user_id"]: r for r in clean_transactions(spark.createDataFrame(raw, RAW)).collect()}
    assert table.keys() == {1, 4}
    assert table[1]["browser"] == "unknown"
    assert (table[4]["purchase_value"], table[4]["age"]) == (10.0, 30)


def test_identifiers_are_filled_only_on_request(spark):
    raw = [(1, "2024-01-01 00:00:00", "2024-01-01 01:00:00", 1.0, "D", "A", "B", "M", 30, ip, 0) for ip in (5.0, None)]
    df = spark.createDataFrame(raw, RAW)
    assert clean_transactions(df).where("ip_address IS NULL").count() == 1
    assert clean_transactions(df, fill_identifiers=True).where("ip_address IS NULL").count() == 0


def test_card_and_range_jobs(spark, rows):
    cards = spark.createDataFrame([(0.0, 1.0, None, 0), (0.0, 1.0, None, 0), (1.0, 2.0, 8.0, 1)],
                                  "Time double, V1 double, Amount double, Class int")
    assert rows(clean_cards(cards)) == [(0.0, 1.0, 8.0, 0), (1.0, 2.0, 8.0, 1)]
    ranges = spark.createDataFrame([(1.0, 5.0, " A "), (1.0, 5.0, "B"), (7.0, None, "C"), (9.0, 10.0, None)],
                                   "lower_bound_ip_address double, upper_bound_ip_address double, country string")
    assert rows(clean_ip_ranges(ranges)) == [(1, 5, "A")]

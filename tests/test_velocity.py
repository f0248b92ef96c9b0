import datetime as dt
import random

import pytest

from txnlens.operators import running
from txnlens.operators.velocity import add_velocity

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, user_id long, purchase_time timestamp_ntz"
COLUMNS = ["hours_since_last_txn", "user_cumulative_txn_count", "user_txn_velocity_per_day",
           "txn_count_last_1h", "txn_count_last_24h", "txn_count_last_168h"]


def brute(events, as_of_row=False):
    out = {}
    by_user = {}
    for e in events:
        by_user.setdefault(e[1], []).append(e)
    for mine in by_user.values():
        mine.sort(key=lambda e: (e[2], e[0]))
        times = [e[2] for e in mine]
        for i, (key, _, t) in enumerate(mine):
            last = t if as_of_row else times[-1]
            days = max((last - times[0]).total_seconds() / 86400, 1 / 24)
            out[key] = (
                (t - times[i - 1]).total_seconds() / 3600 if i else 0.0, i + 1, (i + 1) / days,
                *[sum(t - dt.timedelta(hours=h) <= x <= t for x in times) for h in (1, 24, 168)])
    return out


def make(seed, n=400, users=7):
    rng = random.Random(seed)
    steps = [0, 0, 60, 1800, 3600, 86_400, 86_400 * 7, 12_345.678]
    events = []
    for i in range(n):
        at = START + dt.timedelta(seconds=rng.choice(steps) * rng.randrange(4) + rng.choice([0, 0.000001]))
        events.append((i, rng.randrange(users) if rng.random() < 0.7 else 0, at))
    return events


@pytest.mark.parametrize("options", [
    {}, {"hot_rows": None}, {"hot_rows": 1}, {"hot_rows": 1, "rows_per_stretch": 150}, {"hot_rows": 60, "rows_per_stretch": 40}])
@pytest.mark.parametrize("as_of_row", [False, True])
def test_against_brute_force(spark, options, as_of_row):
    events = make(3)
    got = add_velocity(spark.createDataFrame(events, SCHEMA), as_of_row=as_of_row, **options)
    want = brute(events, as_of_row)
    table = {r["event_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert table.keys() == want.keys()
    for key, values in want.items():
        assert table[key] == pytest.approx(values, abs=1e-9), key


@pytest.mark.parametrize("stretch", [37, 1000])
def test_a_burst_in_one_instant_splits(spark, stretch, monkeypatch):
    """Half of all rows are one user's in one second; no stretch takes much more than its share of rows."""
    events = make(5, n=300) + [(1000 + i, 0, START + dt.timedelta(hours=5)) for i in range(300)]
    seen = []
    keep = running.materialize
    monkeypatch.setattr(running, "materialize", lambda df, label, **b: seen.append(keep(df, label, **b)) or seen[-1])
    got = add_velocity(spark.createDataFrame(events, SCHEMA), hot_rows=1, rows_per_stretch=stretch)
    want = brute(events)
    table = {r["event_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    for k, values in want.items():
        assert table[k] == pytest.approx(values, abs=1e-9), k
    assert max(r["count"] for r in seen[-1].groupBy("__part").count().collect()) < 4 * stretch


def test_three_purchases(spark):
    df = spark.createDataFrame([(1, 1, START), (2, 1, START + dt.timedelta(days=1)), (3, 1, START + dt.timedelta(days=2))], SCHEMA)
    table = add_velocity(df).orderBy("event_id").collect()
    assert [r["user_txn_velocity_per_day"] for r in table] == [0.5, 1.0, 1.5]
    assert [r["txn_count_last_24h"] for r in table] == [1, 2, 2]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_rows_without_time(spark, hot_rows):
    df = spark.createDataFrame([(1, 1, START), (2, 1, None), (3, 1, START), (4, 2, None)], SCHEMA)
    table = {r["event_id"]: r for r in add_velocity(df, hot_rows=hot_rows).collect()}
    assert table[2]["user_cumulative_txn_count"] == 3
    assert [table[i]["txn_count_last_1h"] for i in (1, 2, 3, 4)] == [2, 0, 2, 1]
    assert table[2]["hours_since_last_txn"] == 0.0


def test_one_exchange_per_table(spark):
    plan = add_velocity(spark.createDataFrame(make(1), SCHEMA), hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_missing_column(spark):
    with pytest.raises(ValueError, match="user_id"):
        add_velocity(spark.range(1).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' AS purchase_time"))


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_rows_without_user_stand_alone(spark, hot_rows):
    df = spark.createDataFrame([(i, None if i < 3 else 1, START) for i in range(6)], SCHEMA)
    table = {r["event_id"]: r for r in add_velocity(df, hot_rows=hot_rows).collect()}
    assert [table[i]["txn_count_last_1h"] for i in range(6)] == [1, 1, 1, 3, 3, 3]
    assert [table[i]["user_cumulative_txn_count"] for i in range(3)] == [1, 1, 1]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_order_key_may_repeat(spark, hot_rows):
    df = spark.createDataFrame([(1, 1, START + dt.timedelta(hours=i)) for i in range(5)], SCHEMA)
    rows = add_velocity(df, hot_rows=hot_rows).orderBy("purchase_time").collect()
    assert [r["user_cumulative_txn_count"] for r in rows] == [1, 2, 3, 4, 5]
    assert [r["hours_since_last_txn"] for r in rows] == [0.0, 1.0, 1.0, 1.0, 1.0]

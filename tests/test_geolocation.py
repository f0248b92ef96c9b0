import random

import pytest

from txnlens.operators.geolocation import UNKNOWN, attach_country, disjoint_ranges, match_quality
from txnlens.operators.segments import rate_by
from txnlens.plans.preparation import clean_ip_ranges

RANGES = "lower_bound_ip_address long, upper_bound_ip_address long, country string"
WAYS = [{}, {"max_broadcast_ranges": 0, "salts": 3}]


def lookup(spark, ips, ranges, **options):
    events = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id long, ip_address_int long")
    found = attach_country(events, spark.createDataFrame(ranges, RANGES), **options)
    return [r["country"] for r in sorted(found.collect(), key=lambda r: r["id"])]


def expected(ip, ranges):
    """The latest range at or below; of equal lower bounds the longest, then by name."""
    below = [r for r in ranges if ip is not None and r[0] <= ip]
    if not below:
        return UNKNOWN
    low, high, country = min(below, key=lambda r: (-r[0], -r[1], r[2]))
    return country if ip <= high else UNKNOWN


@pytest.mark.parametrize("options", WAYS)
def test_adjacent_ranges(spark, options):
    ranges = [(16777216, 16777471, "Australia"), (16777472, 16777727, "China")]
    assert lookup(spark, [16777216, 16777472, 999, None], ranges, **options) == ["Australia", "China", UNKNOWN, UNKNOWN]


@pytest.mark.parametrize("options", WAYS)
def test_overlap_is_as_of_not_containment(spark, options):
    ranges = [(0, 100, "A"), (10, 20, "B"), (200, 210, "C")]
    assert lookup(spark, [5, 15, 50, 205], ranges, **options) == ["A", "B", UNKNOWN, "C"]


@pytest.mark.parametrize("options", WAYS)
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, options, seed):
    rng = random.Random(seed)
    ranges = []
    for i in range(200):
        low = rng.choice([rng.randrange(2**32), rng.randrange(300_000), 65_536 * rng.randrange(5)])
        ranges.append((low, min(low + rng.choice([0, 10, 70_000, 5_000_000]), 2**32 - 1), f"c{i % 50}"))
    ips = [rng.choice([rng.randrange(2**32), rng.randrange(400_000), rng.choice(ranges)[0], rng.choice(ranges)[1]])
           for _ in range(800)] + [None, 0, 2**32 - 1]
    assert lookup(spark, ips, ranges, **options) == [expected(ip, ranges) for ip in ips]


def test_disjoint_ranges_do_not_touch(spark):
    ranges = [(i * 1000, i * 1000 + 5000, f"c{i}") for i in range(300)]
    cut = sorted((r["lower"], r["upper"]) for r in disjoint_ranges(spark.createDataFrame(ranges, RANGES)).collect())
    assert len(cut) == 300
    assert all(a[1] < b[0] for a, b in zip(cut, cut[1:], strict=False))


def test_one_address_with_most_rows(spark):
    ips = [7] * 3000 + [None] * 3000 + [500]
    got = lookup(spark, ips, [(0, 10, "A"), (400, 600, "B")], max_broadcast_ranges=0, salts=8)
    assert (got.count("A"), got.count(UNKNOWN), got.count("B")) == (3000, 3000, 1)


def test_country_rates(spark):
    df = spark.createDataFrame([("A", 0), ("A", 0), ("A", 1), ("B", 1), ("B", 1), ("C", 1)], "country string, class int")
    table = rate_by(df, "country", min_transactions=2)
    assert [tuple(r) for r in table.collect()] == [("B", 2, 2, 100.0), ("A", 3, 1, 33.333)]


def test_match_quality(spark):
    df = spark.createDataFrame([("A",), ("A",), ("unknown",)], "country string")
    assert tuple(match_quality(df).first()) == (3, 2, 66.67, 1, 1)


def test_a_missing_name_never_hides_a_known_one(spark):
    raw = spark.createDataFrame([(0, 10, None), (0, 10, "Peru"), (20, 30, None)], RANGES)
    assert [tuple(r) for r in clean_ip_ranges(raw).collect()] == [(0, 10, "Peru")]
    assert [r["country"] for r in disjoint_ranges(raw).where("lower = 0").collect()] == ["Peru"]


@pytest.mark.parametrize("options", WAYS)
def test_events_may_hold_any_type(spark, options):
    events = spark.sql("SELECT id, map('a', id) AS m, CASE WHEN id < 90 THEN NULL ELSE id END AS ip_address_int FROM range(100)")
    found = attach_country(events, spark.createDataFrame([(95, 99, "Peru")], RANGES), **options)
    assert {(r["country"], r["n"]) for r in found.groupBy("country").count().withColumnRenamed("count", "n").collect()} == {("Peru", 5), (UNKNOWN, 95)}

"""DuckDB SQL for every registered query that SQL can express.

Each text is written from the operator's definition, not from the Spark plan: the lookup uses
``ASOF JOIN``, counts use range frames, quantiles ``quantile_cont``.
"""

from __future__ import annotations

# Views over the given tables, as common table expressions.
TXN = """
txn AS (
  SELECT e.event_id, e.user_id, s.signup_time, e.ts AS purchase_time, e.value AS purchase_value,
         concat('D', cast(e.event_id % 97 AS varchar)) AS device_id,
         CASE e.event_id % 3 WHEN 0 THEN 'SEO' WHEN 1 THEN 'Ads' ELSE 'Direct' END AS source,
         CASE (e.event_id * 7) % 5 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'IE' WHEN 2 THEN 'Safari'
              WHEN 3 THEN 'FireFox' ELSE 'Opera' END AS browser,
         CASE WHEN e.user_id % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
         cast(18 + e.user_id % 50 AS bigint) AS age,
         cast((e.event_id * 2654435761) % 4294967296 AS double) + 0.25 AS ip_address,
         CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS class
  FROM events e
  JOIN (SELECT user_id, min(ts) AS signup_time FROM events GROUP BY user_id) s ON e.user_id = s.user_id
)"""
IPR = """
ipr AS (
  SELECT cast(n_nationkey AS bigint) * 171798691 AS lo,
         cast(n_nationkey AS bigint) * 171798691 + 150000000 AS hi, n_name AS country
  FROM nation
)"""
GEO = TXN + "," + IPR + """,
geo AS (
  SELECT t.*, cast(floor(t.ip_address) AS bigint) AS ip_address_int,
         CASE WHEN r.hi >= floor(t.ip_address) THEN r.country ELSE 'unknown' END AS country
  FROM txn t ASOF LEFT JOIN ipr r ON cast(floor(t.ip_address) AS bigint) >= r.lo
)"""
DIRTY = TXN + """,
dirty AS (
  SELECT event_id, user_id,
         CASE WHEN event_id % 17 = 0 THEN 'not-a-time'
              ELSE substr(cast(signup_time AS varchar), 1, 19) END AS signup_time,
         substr(cast(purchase_time AS varchar), 1, 19) AS purchase_time,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE purchase_value END AS purchase_value,
         device_id, source,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE browser END AS browser, sex,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE age END AS age, ip_address,
         CASE WHEN event_id % 19 = 0 THEN NULL ELSE class END AS class
  FROM (SELECT * FROM txn UNION ALL SELECT * FROM txn WHERE event_id % 10 = 0)
)"""
IPTEXT = """
ip_raw AS (
  SELECT event_id, n,
         CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 'not-an-ip'
              WHEN event_id % 31 = 0 THEN '192.168.00.1' WHEN event_id % 37 = 0 THEN '300.1.1.1'
              ELSE 'valid' END AS ip_text
  FROM (SELECT event_id, (event_id * 2654435761) % 4294967296 AS n FROM events)
)"""
SCORED = TXN + """,
scored AS (
  SELECT event_id, 'model_a' AS model_name, class AS y,
         round(cast((event_id * 37) % 101 AS double) / cast(101 AS double) * cast(0.7 AS double)
               + cast(0.3 AS double) * class, 4) AS score
  FROM txn
  UNION ALL
  SELECT event_id, 'model_b', class, round(cast((event_id * 53) % 97 AS double) / cast(97 AS double), 4)
  FROM txn
)"""
CARD = """
card AS (
  SELECT cast(l_orderkey AS double) AS time, l_quantity AS v1, l_discount AS v2, l_tax AS v3,
         CASE WHEN l_orderkey % 12 = 0 THEN NULL ELSE l_extendedprice END AS amount,
         CASE WHEN l_discount > cast(0.095 AS double) AND l_tax > cast(0.075 AS double) THEN 1 ELSE 0 END AS class
  FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0)
)"""
TIMED = TXN + """,
timed AS (
  SELECT *, (epoch_us(purchase_time) - epoch_us(signup_time)) / cast(3600000000 AS double) AS hours,
         hour(purchase_time) AS hour_of_day, isodow(purchase_time) - 1 AS day_of_week
  FROM txn
)"""


def velocity(source: str, user: str, time: str, key: str, windows: tuple[int, ...], until: str) -> str:
    frames = ",\n".join(
        f"count(*) OVER (PARTITION BY {user} ORDER BY {time} RANGE BETWEEN INTERVAL {h} HOUR PRECEDING "
        f"AND CURRENT ROW) AS txn_count_last_{h}h" for h in windows)
    end = f"max({time}) OVER (PARTITION BY {user})" if until == "last" else time
    return f"""
velocity AS (
  SELECT *, user_cumulative_txn_count / greatest(
              (epoch_us(until_time) - epoch_us(first_time)) / cast(86400000000 AS double),
              cast(1 AS double) / 24) AS user_txn_velocity_per_day
  FROM (
    SELECT {source}.*,
           coalesce((epoch_us({time}) - epoch_us(lag({time}) OVER (PARTITION BY {user} ORDER BY {time}, {key})))
                    / cast(3600000000 AS double), 0) AS hours_since_last_txn,
           row_number() OVER (PARTITION BY {user} ORDER BY {time}, {key}) AS user_cumulative_txn_count,
           min({time}) OVER (PARTITION BY {user}) AS first_time, {end} AS until_time,
           {frames}
    FROM {source})
)"""


VELOCITY_COLUMNS = """round(hours_since_last_txn, 6) AS hours_since_last_txn, user_cumulative_txn_count,
       round(user_txn_velocity_per_day, 6) AS user_txn_velocity_per_day"""
ENGINEERED = TIMED + "," + velocity("timed", "user_id", "purchase_time", "event_id", (1, 24, 168), "last") + "," + IPR + """,
eng AS (
  SELECT v.*, v.hours AS time_since_signup_hours, cast(floor(v.ip_address) AS bigint) AS ip_address_int,
         CASE WHEN r.hi >= floor(v.ip_address) THEN r.country ELSE 'unknown' END AS country
  FROM velocity v ASOF LEFT JOIN ipr r ON cast(floor(v.ip_address) AS bigint) >= r.lo
)"""
NUMERIC = ("purchase_value", "age", "time_since_signup_hours", "hour_of_day", "day_of_week", "txn_count_last_1h",
           "txn_count_last_24h", "txn_count_last_168h", "hours_since_last_txn", "user_cumulative_txn_count",
           "user_txn_velocity_per_day")
CATEGORICAL = ("source", "browser", "sex", "country")


def matrix(numeric: tuple[str, ...], categorical: tuple[str, ...], source: str) -> str:
    numbers = "\nUNION ALL\n".join(
        f"SELECT event_id, class, '{c}' AS feature, cast({c} AS double) AS x FROM {source}" for c in numeric)
    texts = "\nUNION ALL\n".join(
        f"""SELECT s.event_id, s.class, concat('{c}_', k.v) AS feature,
                   CASE WHEN s.{c} = k.v THEN cast(1 AS double) ELSE cast(0 AS double) END AS value
            FROM {source} s CROSS JOIN (SELECT DISTINCT {c} AS v FROM {source}) k""" for c in categorical)
    return f"""
num AS ({numbers}),
moments AS (SELECT feature, avg(x) AS m, stddev_pop(x) AS d FROM num GROUP BY feature),
matrix AS (
  SELECT event_id, class, num.feature, (x - m) / CASE WHEN d = 0 THEN 1 ELSE d END AS value
  FROM num JOIN moments ON num.feature = moments.feature
  UNION ALL
  {texts}
)"""


def digest(seed: str, key: str) -> str:
    return f"md5(concat('{seed}-', cast({key} AS varchar)))"


def uniform_int(seed: str, key: str) -> str:
    return f"cast(concat('0x', substr({digest(seed, key)}, 1, 15)) AS bigint)"


def rates(column: str, source: str, floor_rows: int = 0) -> str:
    return f"""
SELECT {column}, count(class) AS transactions, cast(sum(class) AS bigint) AS fraud_cases,
       round(cast(sum(class) AS double) / count(class) * 100, 3) AS fraud_rate_pct
FROM {source} GROUP BY {column} HAVING count(class) >= {floor_rows}"""


def split_counts(source: str) -> str:
    """Train rows per class by largest remainder, with a fifth held out."""
    return f"""
sizes AS (SELECT class, count(*) AS n FROM {source} GROUP BY class),
totals AS (SELECT class, n, sum(n) OVER () AS total FROM sizes),
shares AS (
  SELECT class, n, total - ceil(total * cast(0.2 AS double)) AS train_total,
         n * (total - ceil(total * cast(0.2 AS double))) / cast(total AS double) AS share FROM totals),
want AS (
  SELECT class, n, cast(floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, class)
                        <= train_total - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS bigint) AS train_n
  FROM shares)"""


STEPS = SCORED + """,
at_score AS (SELECT model_name, score, sum(y) AS p, count(*) AS n FROM scored GROUP BY model_name, score),
steps AS (
  SELECT model_name, score, p, n,
         sum(p) OVER (PARTITION BY model_name ORDER BY score DESC) AS tp,
         sum(n) OVER (PARTITION BY model_name ORDER BY score DESC) AS flagged,
         sum(p) OVER (PARTITION BY model_name) AS all_p, sum(n) OVER (PARTITION BY model_name) AS all_n
  FROM at_score)"""
COMPARED = STEPS + """,
ranked AS (
  SELECT model_name,
         sum(cast(n - p AS double) * (tp - p / cast(2 AS double))) / (max(all_p) * cast(max(all_n - all_p) AS double)) AS roc_auc,
         sum(cast(p AS double) * tp / flagged) / max(all_p) AS pr_auc
  FROM steps GROUP BY model_name),
counts AS (
  SELECT model_name,
         count(*) FILTER (WHERE y = 1 AND score > 0.5) AS true_positives,
         count(*) FILTER (WHERE y = 0 AND score > 0.5) AS false_positives,
         count(*) FILTER (WHERE y = 1 AND score <= 0.5) AS false_negatives,
         count(*) FILTER (WHERE y = 0 AND score <= 0.5) AS true_negatives
  FROM scored GROUP BY model_name),
compared AS (
  SELECT c.*, r.roc_auc, r.pr_auc,
         cast(true_positives + true_negatives AS double)
           / (true_positives + true_negatives + false_positives + false_negatives) AS accuracy,
         coalesce(cast(true_positives AS double) / nullif(true_positives + false_positives, 0), 0) AS precision,
         coalesce(cast(true_positives AS double) / nullif(true_positives + false_negatives, 0), 0) AS recall,
         coalesce(cast(2 * true_positives AS double)
                  / nullif(2 * true_positives + false_positives + false_negatives, 0), 0) AS f1
  FROM counts c JOIN ranked r ON c.model_name = r.model_name)"""
CONFUSION = "true_positives, false_positives, false_negatives, true_negatives"

VECTORS = """
vec AS (SELECT vec_id, cast(embedding AS double[]) AS features, CASE WHEN label = 0 THEN 1 ELSE 0 END AS class
        FROM embeddings),
rare AS (SELECT * FROM vec WHERE class = 1),
near AS (
  SELECT vec_id, neighbor, distance, rank FROM (
    SELECT vec_id, neighbor, distance,
           row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor) AS rank
    FROM (SELECT a.vec_id, b.vec_id AS neighbor, round(list_distance(a.features, b.features), 6) AS distance
          FROM rare a JOIN rare b ON a.vec_id <> b.vec_id))
  WHERE rank <= 5)"""
LINEAR = f"""
vec AS (SELECT vec_id, cast(embedding AS double[]) AS features FROM embeddings),
cell AS (SELECT vec_id, unnest(generate_series(0, len(features) - 1)) AS j, unnest(features) AS x FROM vec),
background AS (
  SELECT vec_id FROM (SELECT vec_id, row_number() OVER (ORDER BY {digest("42", "vec_id")}) AS n FROM vec)
  WHERE n <= 200),
mu AS (SELECT j, avg(x) AS m FROM cell JOIN background USING (vec_id) GROUP BY j),
phi AS (
  SELECT vec_id, concat('f', cast(cell.j AS varchar)) AS feature, x,
         (x - m) * (((cell.j * 7) % 13 - 6) / cast(10 AS double)) AS phi
  FROM cell JOIN mu ON cell.j = mu.j)"""
SHAP_RANK = """
SELECT feature, avg(abs(phi)) AS mean_abs_shap, avg(phi) AS mean_shap FROM phi GROUP BY feature"""


def with_views(views: str, body: str) -> str:
    return f"WITH {views.strip()}\n{body.strip()}"


def describe_sql(source: str, columns: dict[str, str], pick: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT {pick.format(c=c, t=t)} FROM {source}" for c, t in columns.items())


DIRTY_TYPES = {
    "event_id": "bigint", "user_id": "bigint", "signup_time": "string", "purchase_time": "string",
    "purchase_value": "double", "device_id": "string", "source": "string", "browser": "string", "sex": "string",
    "age": "bigint", "ip_address": "double", "class": "int"}
RANGES = """
wide AS (
  SELECT (s_suppkey * 40000003) % 4294967296 AS lo, (s_suppkey * 40000003) % 4294967296 + 90000000 AS hi,
         s_name AS country
  FROM supplier)"""
DIRTY_RANGES = """
dirty_ranges AS (
  SELECT s_suppkey * 1000 AS lo, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey * 1000 + 900 END AS hi,
         CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE concat('  ', s_name, ' ') END AS country
  FROM supplier
  UNION ALL
  SELECT s_suppkey * 1000, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey * 1000 + 900 END,
         concat('  ', s_name, 'b ')
  FROM supplier)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    # Addresses and countries.
    sql["geo_country"] = with_views(GEO, "SELECT event_id, ip_address_int, country FROM geo")
    sql["geo_country_rates"] = with_views(GEO, rates("country", "geo", 100))
    sql["geo_match_quality"] = with_views(GEO, """
SELECT count(*) AS total, count(*) FILTER (WHERE country <> 'unknown') AS matched,
       round(count(*) FILTER (WHERE country <> 'unknown') * cast(100 AS double) / count(*), 2) AS matched_pct,
       count(*) FILTER (WHERE country = 'unknown') AS unmatched,
       count(DISTINCT country) FILTER (WHERE country <> 'unknown') AS countries FROM geo""")
    sql["geo_overlapping_ranges"] = with_views(TXN + "," + RANGES, """
SELECT t.event_id, CASE WHEN r.hi >= floor(t.ip_address) THEN r.country ELSE 'unknown' END AS country
FROM txn t ASOF LEFT JOIN wide r ON cast(floor(t.ip_address) AS bigint) >= r.lo""")
    sql["ip_parse"] = with_views(IPTEXT, """
SELECT event_id, CASE WHEN ip_text = 'valid' THEN n END AS ip_int FROM ip_raw""")
    sql["geolocated_table_sink"] = with_views(GEO, """
SELECT country, count(*) AS n, round(sum(purchase_value), 4) AS total_value, cast(sum(ip_address_int) AS bigint) AS ip_sum
FROM geo GROUP BY country""")
    # Time and velocity.
    sql["temporal_features"] = with_views(TIMED, """
SELECT event_id, round(hours, 6) AS time_since_signup_hours, hour_of_day, day_of_week FROM timed""")
    for name, until in (("velocity_txn", "last"), ("velocity_as_of_row", "row")):
        sql[name] = with_views(TXN + "," + velocity("txn", "user_id", "purchase_time", "event_id", (1, 24, 168), until), f"""
SELECT event_id, {VELOCITY_COLUMNS}, txn_count_last_1h, txn_count_last_24h, txn_count_last_168h FROM velocity""")
    sql["velocity_orders"] = with_views(
        velocity("orders", "o_custkey", "o_orderdate", "o_orderkey", (24, 720, 8760), "last"), f"""
SELECT o_orderkey, {VELOCITY_COLUMNS}, txn_count_last_24h, txn_count_last_720h, txn_count_last_8760h FROM velocity""")
    sql["velocity_hot_users"] = sql["velocity_txn"]
    sql["velocity_burst"] = with_views(TXN + """,
burst AS (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1 ELSE user_id END AS user_id,
         CASE WHEN event_id % 2 = 0 THEN timestamp '2024-01-05 12:00:00' + to_microseconds((event_id * 7919 % 10) * 100000)
              ELSE purchase_time END AS purchase_time
  FROM txn),""" + velocity("burst", "user_id", "purchase_time", "event_id", (1, 24, 168), "last"), f"""
SELECT event_id, {VELOCITY_COLUMNS}, txn_count_last_1h, txn_count_last_24h, txn_count_last_168h FROM velocity""")
    sql["velocity_null_users"] = with_views(TXN + """,
ownerless AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN -1 - event_id ELSE user_id END AS owner FROM txn),""" + velocity(
        "ownerless", "owner", "purchase_time", "event_id", (1, 24, 168), "last"), f"""
SELECT event_id, {VELOCITY_COLUMNS}, txn_count_last_1h, txn_count_last_24h, txn_count_last_168h FROM velocity""")
    # Sources, names, types.
    sql["csv_roundtrip"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, epoch_us(o_orderdate) AS order_us FROM orders"""
    sql["snake_columns"] = """
SELECT c_custkey AS customer_key, c_name AS name_, c_acctbal AS acct_balance, c_mktsegment AS market_segment FROM customer"""
    sql["coerce_types"] = with_views(DIRTY, """
SELECT event_id, try_cast(signup_time AS double) AS signup_number, cast(age AS double) AS age,
       cast(class AS varchar) AS class FROM dirty""")
    # Cleaning.
    kept = "try_strptime(signup_time, '%Y-%m-%d %H:%M:%S') IS NOT NULL AND class IS NOT NULL"
    sql["clean_missing_median"] = with_views(DIRTY, """
SELECT event_id, coalesce(purchase_value, (SELECT median(purchase_value) FROM dirty WHERE class IS NOT NULL)) AS purchase_value,
       coalesce(cast(age AS double), (SELECT median(age) FROM dirty WHERE class IS NOT NULL)) AS age,
       coalesce(browser, 'unknown') AS browser, class
FROM dirty WHERE class IS NOT NULL""")
    sql["clean_missing_mean"] = with_views(DIRTY, """
SELECT event_id, round(coalesce(purchase_value, (SELECT avg(purchase_value) FROM dirty)), 6) AS purchase_value,
       round(coalesce(cast(age AS double), (SELECT avg(age) FROM dirty)), 6) AS age,
       round(coalesce(cast(class AS double), (SELECT avg(class) FROM dirty)), 6) AS class FROM dirty""")
    sql["clean_missing_zero"] = with_views(DIRTY, """
SELECT event_id, coalesce(purchase_value, 0) AS purchase_value, coalesce(age, 0) AS age, coalesce(class, 0) AS class FROM dirty""")
    sql["clean_mode"] = with_views(DIRTY, """
SELECT event_id, coalesce(browser, (SELECT browser FROM dirty WHERE browser IS NOT NULL GROUP BY browser
                                    ORDER BY count(*) DESC, browser LIMIT 1)) AS browser FROM dirty""")
    sql["dedup_rows"] = with_views(DIRTY, "SELECT DISTINCT event_id, user_id, browser, class FROM dirty")
    for name, order in (("dedup_first", "ASC"), ("dedup_last", "DESC")):
        sql[name] = with_views(DIRTY, f"""
SELECT DISTINCT user_id, browser, event_id, purchase_value FROM (
  SELECT *, dense_rank() OVER (PARTITION BY user_id, browser ORDER BY event_id {order}) AS n FROM dirty) WHERE n = 1""")
    sql["dedup_none"] = with_views(DIRTY, """
SELECT event_id, user_id, browser, purchase_value FROM dirty
WHERE event_id IN (SELECT event_id FROM dirty GROUP BY event_id HAVING count(*) = 1)""")
    sql["parse_timestamps"] = with_views(DIRTY, """
SELECT event_id, epoch_us(try_strptime(signup_time, '%Y-%m-%d %H:%M:%S')) AS signup_us,
       epoch_us(try_strptime(purchase_time, '%Y-%m-%d %H:%M:%S')) AS purchase_us FROM dirty""")
    sql["unparsed_counts"] = with_views(DIRTY, " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NOT NULL
  AND try_strptime({c}, '%Y-%m-%d %H:%M:%S') IS NULL) AS invalid FROM dirty""" for c in ("signup_time", "purchase_time")))
    sql["clean_fraud_job"] = with_views(DIRTY + f""",
kept AS (SELECT DISTINCT * FROM dirty WHERE {kept})""", """
SELECT event_id, user_id, epoch_us(strptime(signup_time, '%Y-%m-%d %H:%M:%S')) AS signup_us,
       epoch_us(strptime(purchase_time, '%Y-%m-%d %H:%M:%S')) AS purchase_us,
       coalesce(purchase_value, (SELECT median(purchase_value) FROM kept)) AS purchase_value,
       cast(floor(coalesce(cast(age AS double), (SELECT median(age) FROM kept))) AS bigint) AS age,
       coalesce(browser, 'unknown') AS browser, source, sex, device_id, ip_address, cast(class AS bigint) AS class
FROM kept""")
    sql["clean_card_job"] = with_views(CARD + ", kept AS (SELECT DISTINCT * FROM card)", """
SELECT time, v1, v2, v3, coalesce(amount, (SELECT median(amount) FROM kept)) AS amount, cast(class AS bigint) AS class FROM kept""")
    sql["clean_ranges_job"] = with_views(DIRTY_RANGES, """
SELECT lower_bound_ip_address, upper_bound_ip_address, trim(country) AS country FROM (
  SELECT lo AS lower_bound_ip_address, hi AS upper_bound_ip_address, country,
         row_number() OVER (PARTITION BY lo, hi ORDER BY country) AS n FROM dirty_ranges
  WHERE lo IS NOT NULL AND hi IS NOT NULL AND country IS NOT NULL)
WHERE n = 1""")
    # Profiles.
    numeric = {c: t for c, t in DIRTY_TYPES.items() if t != "string"}
    stats = """'{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       cast(min({c}) AS double) AS min, cast(quantile_cont({c}, 0.25) AS double) AS p25,
       cast(quantile_cont({c}, 0.5) AS double) AS p50, cast(quantile_cont({c}, 0.75) AS double) AS p75,
       cast(max({c}) AS double) AS max, '{t}' AS dtype, count(*) - count({c}) AS missing"""
    sql["describe_numeric"] = with_views(DIRTY, describe_sql("dirty", numeric, stats))
    texts = {c: t for c, t in DIRTY_TYPES.items() if t == "string"}
    sql["describe_strings"] = with_views(DIRTY, describe_sql("dirty", texts, """'{c}' AS "column", '{t}' AS dtype,
       count({c}) AS count, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS unique,
       (SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT count(*) FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq"""))
    sql["describe_all"] = with_views(DIRTY, describe_sql("dirty", numeric, """'{c}' AS "column", '{t}' AS dtype,
       count({c}) AS count, count(*) - count({c}) AS missing, cast(quantile_cont({c}, 0.5) AS double) AS p50,
       cast(NULL AS bigint) AS unique""") + "\nUNION ALL\n" + describe_sql("dirty", texts, """'{c}', '{t}', count({c}),
       count(*) - count({c}), cast(NULL AS double), count(DISTINCT {c})"""))
    sql["describe_five"] = with_views(ENGINEERED, describe_sql("eng", dict.fromkeys(NUMERIC[:5], ""), """'{c}' AS "column",
       count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, round(min({c}), 2) AS min,
       round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50,
       round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS max"""))
    sql["missing_summary"] = with_views(DIRTY, describe_sql("dirty", DIRTY_TYPES, """'{c}' AS "column",
       count(*) - count({c}) AS missing_count, round(cast(count(*) - count({c}) AS double) / count(*) * 100, 2) AS missing_pct,
       '{t}' AS dtype"""))
    sql["column_overview"] = with_views(DIRTY, describe_sql("dirty", DIRTY_TYPES, """'{c}' AS "column", '{t}' AS dtype,
       count({c}) AS non_null, count(*) - count({c}) AS missing,
       round(cast(count(*) - count({c}) AS double) / count(*) * 100, 2) AS missing_pct, count(DISTINCT {c}) AS unique"""))
    sql["column_profile"] = with_views(DIRTY, describe_sql("dirty", DIRTY_TYPES, """'{c}' AS "column", '{t}' AS dtype,
       round(cast(count({c}) AS double) / count(*) * 100, 1) AS non_null_pct"""))
    for name, source, key in (("duplicate_check", "SELECT count(*) AS n FROM dirty GROUP BY ALL", "*"),
                              ("duplicate_check_subset", "SELECT count(*) AS n FROM dirty GROUP BY user_id, browser", "")):
        grouped = f"SELECT {', '.join(DIRTY_TYPES)}, count(*) AS n FROM dirty GROUP BY {', '.join(DIRTY_TYPES)}" if key else source
        sql[name] = with_views(DIRTY + f", copies AS ({grouped})", """
SELECT cast(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS bigint) AS rows_in_duplicate_groups,
       cast(sum(n - 1) AS bigint) AS duplicate_rows_to_remove,
       round(cast(sum(n - 1) AS double) / sum(n) * 100, 4) AS duplicate_pct FROM copies""")
    balance = """
SELECT {stage} class, count AS count, round(cast(count AS double) / sum(count) OVER ({part}) * 100, 4) AS pct,
       CASE WHEN count(*) OVER ({part}) >= 2 THEN
         round(cast(max(count) OVER ({part}) AS double) / min(count) OVER ({part}), 4) END AS imbalance_ratio
FROM counted"""
    sql["class_balance"] = with_views(
        DIRTY + ", counted AS (SELECT class, count(*) AS count FROM dirty GROUP BY class)", balance.format(stage="", part=""))
    sql["balance_by_stage"] = with_views(TXN + """,
counted AS (SELECT source AS stage, class, count(*) AS count FROM txn GROUP BY source, class)""",
                                         balance.format(stage="stage,", part="PARTITION BY stage"))
    sql["stage_balance"] = with_views(TXN + "," + split_counts("txn"), "SELECT class, cast(n - train_n AS bigint) AS count FROM want")
    # Segments.
    sql["rate_by_browser"] = with_views(DIRTY, rates("browser", "dirty"))
    sql["rate_by_segment"] = with_views(TXN, " UNION ALL ".join(
        f"SELECT '{c}' AS segment, {c} AS value, transactions, fraud_cases, fraud_rate_pct FROM ({rates(c, 'txn')})"
        for c in ("browser", "source", "sex")))
    sql["rate_by_age_band"] = with_views(TXN + """,
banded AS (SELECT CASE WHEN age >= 0 AND age <= 25 THEN '<=25' WHEN age > 25 AND age <= 35 THEN '26-35'
                       WHEN age > 35 AND age <= 45 THEN '36-45' WHEN age > 45 AND age <= 55 THEN '46-55'
                       WHEN age > 55 AND age <= 100 THEN '56+' END AS age_band, class FROM txn),
bands AS (SELECT unnest(['<=25', '26-35', '36-45', '46-55', '56+']) AS age_band)""", f"""
SELECT coalesce(b.age_band, r.age_band) AS age_band, coalesce(r.transactions, 0) AS transactions,
       coalesce(r.fraud_cases, 0) AS fraud_cases, r.fraud_rate_pct
FROM bands b FULL JOIN ({rates("age_band", "banded")}) r ON b.age_band = r.age_band""")
    sql["rate_by_value_quartile"] = with_views(TXN + """,
q AS (SELECT quantile_cont(purchase_value, 0.25) AS a, quantile_cont(purchase_value, 0.5) AS b,
             quantile_cont(purchase_value, 0.75) AS c FROM txn),
banded AS (SELECT CASE WHEN purchase_value <= a THEN 1 WHEN purchase_value <= b THEN 2
                       WHEN purchase_value <= c THEN 3 ELSE 4 END AS band, class FROM txn CROSS JOIN q)""",
                                               rates("band", "banded"))
    four = {"purchase_value": "purchase_value", "age": "age", "hours": "time_since_signup_hours",
            "ip_address": "ip_address", "class": "class"}
    sql["corr_matrix"] = with_views(TIMED, " UNION ALL ".join(
        f"SELECT '{a2}' AS a, '{b2}' AS b, round(corr({a}, {b}), 6) AS r FROM timed"
        for a, a2 in four.items() for b, b2 in four.items()))
    sql["corr_embeddings"] = """WITH cells AS (
  SELECT vec_id, j, x FROM (SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS j, unnest(embedding)::double AS x FROM embeddings)
  WHERE (vec_id + j) % 7 <> 0)
SELECT a.j::integer AS i, b.j::integer AS j, round(corr(a.x, b.x), 6) AS r FROM cells a JOIN cells b ON a.vec_id = b.vec_id GROUP BY a.j, b.j"""
    riskiest = ("(SELECT {c} FROM timed GROUP BY {c} ORDER BY round(cast(sum(class) AS double) / count(class) * 100, 3) DESC, "
                "{c} LIMIT 1) AS top_{c}")
    sql["headline_metrics"] = with_views(TIMED, f"""
SELECT round(avg(class) * 100, 6) AS fraud_rate_pct,
       round(cast(greatest(sum(class), count(*) - sum(class)) AS double) / least(sum(class), count(*) - sum(class)), 6) AS imbalance_ratio,
       round(median(hours) FILTER (WHERE class = 0), 6) AS median_hours_legit,
       round(median(hours) FILTER (WHERE class = 1), 6) AS median_hours_fraud,
       {riskiest.format(c="source")}, {riskiest.format(c="browser")} FROM timed""")
    sql["value_kpis"] = with_views(TIMED, """
SELECT round(avg(class), 6) AS fraud_rate, median(purchase_value) AS median_value,
       round(median(hours) FILTER (WHERE class = 0), 6) AS median_hours_legit FROM timed""")
    sql["rate_by_hour"] = with_views(TIMED, """
SELECT hour_of_day, count(*) AS transactions, round(avg(class), 6) AS fraud_rate FROM timed GROUP BY hour_of_day""")
    sql["rate_by_source"] = with_views(TXN, """
SELECT source, count(*) AS transactions, round(avg(class), 6) AS fraud_rate FROM txn GROUP BY source""")
    sql["top_countries"] = with_views(GEO, """
SELECT country, count(*) AS transactions, round(avg(class), 6) AS fraud_rate FROM geo GROUP BY country
HAVING count(*) >= 200 ORDER BY avg(class) DESC, country LIMIT 15""")
    sql["top_categories"] = with_views(TXN, """
SELECT device_id, count(*) AS count FROM txn GROUP BY device_id ORDER BY count(*) DESC, device_id LIMIT 8""")
    sql["class_counts"] = with_views(TXN, """
SELECT CASE class WHEN 0 THEN 'Legitimate' ELSE 'Fraud' END AS class_name, count(*) AS count FROM txn GROUP BY class""")
    bins = """greatest(0, least({bins} - 1, floor(({v} - {lo}) / {w}))) """
    sql["histogram_capped"] = with_views(TIMED, """
SELECT class, cast(greatest(0, least(39, floor(least(hours, 720) / cast(18 AS double)))) AS integer) AS bin, count(*) AS count
FROM timed GROUP BY 1, 2""")
    sql["histogram_plain"] = with_views(TXN + """,
lim AS (SELECT min(purchase_value) AS lo, (max(purchase_value) - min(purchase_value)) / cast(40 AS double) AS w FROM txn)""", f"""
SELECT cast({bins.format(bins=40, v="purchase_value", lo="lo", w="w")} AS integer) AS bin, count(*) AS count
FROM txn CROSS JOIN lim GROUP BY 1""")
    sql["box_stats"] = with_views(TIMED + """,
long AS (SELECT class, 'purchase_value' AS "column", purchase_value AS v FROM timed UNION ALL
         SELECT class, 'age', cast(age AS double) FROM timed UNION ALL
         SELECT class, 'time_since_signup_hours', hours FROM timed),
q AS (SELECT class, "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM long GROUP BY class, "column")""", """
SELECT l.class, l."column", round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       count(v) AS count
FROM long l JOIN q ON l.class = q.class AND l."column" = q."column" GROUP BY l.class, l."column", q1, med, q3""")
    sql["quantiles_refined"] = " UNION ALL ".join(
        f"""SELECT l_returnflag, '{c}' AS "column", cast({p} AS double) AS p, round(quantile_cont({c}, {p}), 4) AS value
FROM lineitem GROUP BY l_returnflag""" for c in ("l_quantity", "l_extendedprice") for p in (0.05, 0.5, 0.95))
    sql["quantiles_null_groups"] = " UNION ALL ".join(
        f"""SELECT flag, 'price' AS "column", cast({p} AS double) AS p, round(quantile_cont(price, {p}), 4) AS value
FROM (SELECT CASE l_returnflag WHEN 'N' THEN NULL WHEN 'A' THEN '' ELSE l_returnflag END AS flag,
             CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price FROM lineitem) GROUP BY flag""" for p in (0.25, 0.5))
    sql["kpis"] = with_views(TXN, """
SELECT count(*) AS transactions, cast(sum(class) AS bigint) AS fraud_cases, round(avg(class), 6) AS fraud_rate FROM txn""")
    sql["dataset_kpis"] = with_views(TXN, """
SELECT cast(count(*) AS bigint) AS observations, count(DISTINCT user_id) AS users, round(avg(class), 6) AS fraud_rate,
       cast(11 AS bigint) AS features FROM txn""")
    # Sampling.
    sql["split_of_repeated_keys"] = with_views(TXN + "," + split_counts("txn"), """
SELECT class, 'train' AS split, train_n AS n FROM want UNION ALL SELECT class, 'test', n - train_n FROM want""")
    sql["stratified_split"] = with_views(TXN + "," + split_counts("txn"), f"""
SELECT t.event_id, t.class, CASE WHEN t.n <= train_n THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, class, row_number() OVER (PARTITION BY class ORDER BY {digest("42", "event_id")}) AS n FROM txn) t
JOIN want w ON t.class = w.class""")
    sql["undersample"] = with_views(TXN, f"""
SELECT event_id, class FROM (
  SELECT event_id, class, row_number() OVER (PARTITION BY class ORDER BY {digest("42", "event_id")}) AS n FROM txn)
WHERE n <= (SELECT min(c) FROM (SELECT count(*) AS c FROM txn GROUP BY class))""")
    sql["seeded_sample"] = with_views(TXN, f"""
SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY {digest("7", "event_id")}) AS n FROM txn) WHERE n <= 2500""")
    sql["stratified_folds"] = with_views(TXN, f"""
SELECT event_id, class, CASE WHEN n <= size * 1 // 3 THEN 0 WHEN n <= size * 2 // 3 THEN 1 ELSE 2 END AS fold FROM (
  SELECT event_id, class, row_number() OVER (PARTITION BY class ORDER BY {digest("42-fold", "event_id")}) AS n,
         count(*) OVER (PARTITION BY class) AS size FROM txn)""")
    sql["class_weights"] = with_views(TXN, """
SELECT class, count(*) AS n, round(cast((SELECT count(*) FROM txn) AS double)
       / ((SELECT count(DISTINCT class) FROM txn) * count(*)), 6) AS weight FROM txn GROUP BY class""")
    # Features.
    sql["scaled_numerics"] = with_views(ENGINEERED + "," + matrix(NUMERIC, ("sex",), "eng"), f"""
SELECT event_id, feature, round(value, 6) AS value FROM matrix WHERE feature IN ({", ".join(f"'{n}'" for n in NUMERIC)})""")
    sql["one_hot"] = with_views(TXN, """
SELECT event_id, cast(class AS bigint) AS class, """ + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN cast(1 AS double) ELSE cast(0 AS double) END AS \"{c}_{v}\""
        for c, values in (("source", ("Ads", "Direct", "SEO")), ("browser", ("Chrome", "FireFox", "IE", "Opera", "Safari")),
                          ("sex", ("F", "M"))) for v in values) + " FROM txn")
    sql["engineered_table"] = with_views(ENGINEERED, f"""
SELECT event_id, user_id, purchase_value, source, browser, sex, age, class, ip_address_int, country,
       round(time_since_signup_hours, 6) AS time_since_signup_hours, hour_of_day, day_of_week, {VELOCITY_COLUMNS},
       txn_count_last_1h, txn_count_last_24h, txn_count_last_168h FROM eng""")
    sql["saved_matrix_holdout"] = with_views(TXN + "," + split_counts("txn") + f""",
placed AS (
  SELECT t.* EXCLUDE (n), t.n <= w.train_n AS train FROM (
    SELECT *, row_number() OVER (PARTITION BY class ORDER BY {digest("42", "event_id")}) AS n FROM txn) t JOIN want w ON t.class = w.class),
moments AS (SELECT avg(purchase_value) AS m0, stddev_pop(purchase_value) AS d0, avg(age) AS m1, stddev_pop(age) AS d1 FROM placed WHERE train),
cells AS (
  SELECT event_id, 'purchase_value' AS feature, (purchase_value - m0) / d0 AS value FROM placed, moments WHERE NOT train UNION ALL
  SELECT event_id, 'age', (age - m1) / d1 FROM placed, moments WHERE NOT train UNION ALL """ + " UNION ALL ".join(
        f"""SELECT event_id, concat('{c}_', v), CASE WHEN {c} = v THEN cast(1 AS double) ELSE cast(0 AS double) END
            FROM placed, (SELECT DISTINCT {c} AS v FROM placed WHERE train) WHERE NOT train""" for c in ("source", "browser", "sex")) + ")", """
SELECT event_id, feature, round(value, 6) AS value, (SELECT count(*) FROM placed WHERE train) AS train_rows FROM cells""")
    identifiers = ("source", "browser", "device_id", "user_id")
    sql["sparse_identifiers"] = with_views(TXN + """,
vocabulary AS (
  SELECT rank, value, row_number() OVER (ORDER BY rank, value) + 1 AS position FROM (""" + " UNION ".join(
        f"SELECT {i} AS rank, cast({c} AS varchar) AS value FROM txn" for i, c in enumerate(identifiers)) + """) WHERE value IS NOT NULL),
moments AS (SELECT avg(purchase_value) AS m0, stddev_pop(purchase_value) AS d0, avg(age) AS m1, stddev_pop(age) AS d1 FROM txn),
cells AS (
  SELECT event_id, 0 AS position, (purchase_value - m0) / CASE WHEN d0 = 0 THEN 1 ELSE d0 END AS value FROM txn, moments UNION ALL
  SELECT event_id, 1, (age - m1) / CASE WHEN d1 = 0 THEN 1 ELSE d1 END FROM txn, moments UNION ALL """ + " UNION ALL ".join(
        f"SELECT t.event_id, v.position, 1.0 FROM txn t JOIN vocabulary v ON v.rank = {i} AND v.value = cast(t.{c} AS varchar)"
        for i, c in enumerate(identifiers)) + ")", """
SELECT event_id, cast(position AS integer) AS position, round(value, 6) AS value FROM cells WHERE value <> 0""")
    sql["feature_matrix"] = with_views(ENGINEERED + "," + matrix(NUMERIC, CATEGORICAL, "eng"), """
SELECT event_id, feature, round(value, 6) AS value FROM matrix""")
    sql["feature_labels"] = with_views(ENGINEERED + "," + matrix(NUMERIC, CATEGORICAL, "eng"), """
SELECT feature, round(avg(abs(value)), 6) AS mean_abs_value,
  CASE WHEN feature LIKE 'country\\_%' ESCAPE '\\' THEN concat('transactions from ', replace(substr(feature, 9), '_', ' '))
       WHEN feature LIKE 'browser\\_%' ESCAPE '\\' THEN concat('using ', substr(feature, 9), ' browser')
       WHEN feature LIKE 'source\\_%' ESCAPE '\\' THEN concat('traffic from ', substr(feature, 8), ' channel')
       WHEN feature LIKE 'sex\\_%' ESCAPE '\\' THEN concat('customer sex = ', substr(feature, 5))
       WHEN feature = 'purchase_value' THEN 'higher purchase amounts' WHEN feature = 'age' THEN 'customer age'
       WHEN feature = 'time_since_signup_hours' THEN 'short time between signup and purchase'
       WHEN feature = 'hour_of_day' THEN 'purchase hour of day' WHEN feature = 'day_of_week' THEN 'purchase day of week'
       WHEN feature = 'txn_count_last_1h' THEN 'many transactions in the last hour'
       WHEN feature = 'txn_count_last_24h' THEN 'many transactions in the last 24 hours'
       WHEN feature = 'txn_count_last_168h' THEN 'many transactions in the last week'
       WHEN feature = 'hours_since_last_txn' THEN 'time since the user''s previous transaction'
       WHEN feature = 'user_cumulative_txn_count' THEN 'user transaction history volume'
       WHEN feature = 'user_txn_velocity_per_day' THEN 'high daily transaction velocity'
       ELSE replace(feature, '_', ' ') END AS label,
  CASE WHEN feature IN ('time_since_signup_hours', 'hour_of_day', 'day_of_week', 'age') THEN 'behavioral_timing'
       WHEN feature LIKE 'country\\_%' ESCAPE '\\' THEN 'geography'
       WHEN feature LIKE 'source\\_%' ESCAPE '\\' THEN 'acquisition_channel'
       WHEN feature LIKE 'browser\\_%' ESCAPE '\\' THEN 'device_browser'
       WHEN feature = 'purchase_value' THEN 'transaction_value' ELSE 'other' END AS category
FROM matrix GROUP BY feature""")
    # Metrics.
    sql["confusion"] = with_views(SCORED, " UNION ALL ".join(f"""
SELECT model_name, 'actual_{a}' AS actual, count(*) FILTER (WHERE y = {a} AND score <= 0.5) AS predicted_0,
       count(*) FILTER (WHERE y = {a} AND score > 0.5) AS predicted_1 FROM scored GROUP BY model_name""" for a in (0, 1)))
    metrics = ("accuracy", "precision", "recall", "f1")
    sql["threshold_metrics"] = with_views(COMPARED, f"""
SELECT model_name, {", ".join(f"round({m}, 6) AS {m}" for m in metrics)}, {CONFUSION} FROM compared""")
    sql["roc_auc"] = with_views(COMPARED, "SELECT model_name, round(roc_auc, 6) AS roc_auc FROM compared")
    sql["average_precision"] = with_views(COMPARED, "SELECT model_name, round(pr_auc, 6) AS pr_auc FROM compared")
    sql["pr_curve"] = with_views(STEPS, """
SELECT model_name, score AS threshold, round(cast(tp AS double) / flagged, 6) AS precision,
       round(cast(tp AS double) / all_p, 6) AS recall FROM steps
UNION ALL SELECT DISTINCT model_name, cast(NULL AS double), cast(1 AS double), cast(0 AS double) FROM scored""")
    sql["roc_curve"] = with_views(STEPS, """
SELECT model_name, score AS threshold, round(cast(flagged - tp AS double) / (all_n - all_p), 6) AS fpr,
       round(cast(tp AS double) / all_p, 6) AS tpr FROM steps
UNION ALL SELECT DISTINCT model_name, cast(NULL AS double), cast(0 AS double), cast(0 AS double) FROM scored""")
    sql["no_skill_baseline"] = with_views(SCORED, """
SELECT model_name, round(avg(y), 6) AS baseline_precision FROM scored GROUP BY model_name""")
    shown = ("precision", "recall", "f1", "roc_auc", "pr_auc")
    sql["model_comparison"] = with_views(COMPARED, f"""
SELECT model_name, {", ".join(f"round({m}, 6) AS {m}" for m in shown)}, {CONFUSION} FROM compared""")
    sql["metrics_long"] = with_views(COMPARED, " UNION ALL ".join(
        f"SELECT model_name, '{m}' AS metric, round({m}, 6) AS score FROM compared" for m in ("precision", "recall", "f1", "pr_auc")))
    sql["best_model_summary"] = with_views(COMPARED, f"""
SELECT model_name, runner_up_model, 'pr_auc' AS selection_metric, {", ".join(f"round({m}, 6) AS {m}" for m in shown)},
       round(pr_auc - next_auc, 6) AS pr_auc_gap_vs_runner_up, {CONFUSION}
FROM (SELECT *, lead(model_name) OVER (ORDER BY pr_auc DESC) AS runner_up_model,
             lead(pr_auc) OVER (ORDER BY pr_auc DESC) AS next_auc, row_number() OVER (ORDER BY pr_auc DESC) AS place
      FROM compared) WHERE place = 1""")
    sql["holdout_rates"] = with_views(COMPARED, """
SELECT model_name, true_positives, true_positives + false_negatives AS total_fraud,
       round(cast(true_positives AS double) / (true_positives + false_negatives), 6) AS fraud_caught_rate, false_positives,
       true_negatives + false_positives AS total_legit,
       round(cast(false_positives AS double) / (true_negatives + false_positives), 6) AS false_alarm_rate FROM compared""")
    # Oversampling.
    sql["smote_neighbors"] = with_views(VECTORS, "SELECT vec_id, rank, neighbor, distance FROM near")
    sql["smote_rows"] = with_views(VECTORS + f""",
numbered AS (SELECT vec_id, row_number() OVER (ORDER BY {digest("42-base", "vec_id")}) - 1 AS row_index FROM rare),
n AS (SELECT count(*) AS rare_n, (SELECT count(*) FROM vec) - 2 * count(*) AS new_n FROM rare),
ids AS (SELECT unnest(generate_series(0, (SELECT new_n - 1 FROM n))) AS i),
picks AS (
  SELECT i, {uniform_int("42-row", "i")} % (SELECT rare_n FROM n) AS row_index,
         {uniform_int("42-neighbor", "i")} % 5 + 1 AS rank,
         {uniform_int("42-share", "i")} / cast(1152921504606846976 AS double) AS share FROM ids),
ends AS (
  SELECT p.i, r.vec_id AS base, s.neighbor, p.share, a.features AS v, b.features AS w
  FROM picks p JOIN numbered r ON p.row_index = r.row_index JOIN near s ON s.vec_id = r.vec_id AND s.rank = p.rank
  JOIN rare a ON a.vec_id = r.vec_id JOIN rare b ON b.vec_id = s.neighbor)""", """
SELECT i AS synthetic_id, base, neighbor, round(share, 6) AS share, j AS position,
       round(x + share * (y - x), 5) AS value
FROM (SELECT i, base, neighbor, share, unnest(generate_series(0, len(v) - 1)) AS j, unnest(v) AS x, unnest(w) AS y FROM ends)""")
    sql["smote_balance"] = with_views(VECTORS + "," + split_counts("vec") + """,
counted AS (
  SELECT 'train_before_resampling' AS stage, class, train_n AS count FROM want UNION ALL
  SELECT 'train_after_resampling', class, (SELECT max(train_n) FROM want) FROM want UNION ALL
  SELECT 'test_holdout_unmodified', class, n - train_n FROM want)""", balance.format(stage="stage,", part="PARTITION BY stage"))
    sql["smote_neighbors_blocked"] = with_views(
        VECTORS.replace("WHERE class = 1", ""), "SELECT vec_id, rank, neighbor, distance FROM near")
    sql["undersample_balance"] = with_views("lab AS (SELECT doc_id, toxic AS class FROM labels)," + split_counts("lab") + """,
counted AS (
  SELECT 'train_before_resampling' AS stage, class, train_n AS count FROM want UNION ALL
  SELECT 'train_after_resampling', class, (SELECT min(train_n) FROM want) FROM want UNION ALL
  SELECT 'test_holdout_unmodified', class, n - train_n FROM want)""", balance.format(stage="stage,", part="PARTITION BY stage"))
    # Attribution.
    sql["linear_shap"] = with_views(LINEAR, "SELECT vec_id, feature, round(phi, 6) AS phi FROM phi")
    sql["shap_rank"] = with_views(LINEAR, f"""
SELECT feature, round(mean_abs_shap, 6) AS mean_abs_shap, round(mean_shap, 6) AS mean_shap,
       CASE WHEN mean_shap > 0 THEN 'increases_fraud_risk' ELSE 'decreases_fraud_risk' END AS impact_direction
FROM ({SHAP_RANK}) ORDER BY mean_abs_shap DESC, feature LIMIT 10""")
    sql["waterfall"] = with_views(LINEAR + """,
placed AS (SELECT vec_id, feature, phi, row_number() OVER (PARTITION BY vec_id ORDER BY abs(phi) DESC, feature) AS place FROM phi)""", """
SELECT vec_id, cast(least(place, 12) AS integer) AS bar,
       CASE WHEN place < 12 THEN feature ELSE 'other features' END AS feature, round(sum(phi), 6) AS phi, count(*) AS features
FROM placed GROUP BY 1, 2, 3""")
    sql["shap_dependence"] = with_views(LINEAR + f", top AS ({SHAP_RANK} ORDER BY mean_abs_shap DESC, feature LIMIT 1)", """
SELECT vec_id, feature, round(x, 6) AS value, round(phi, 6) AS phi FROM phi WHERE feature IN (SELECT feature FROM top)""")
    sql["shap_beeswarm"] = with_views(LINEAR + f", top AS ({SHAP_RANK} ORDER BY mean_abs_shap DESC, feature LIMIT 15)", """
SELECT p.vec_id, p.feature, round(p.x, 6) AS value, round(p.phi, 6) AS phi, round(t.mean_abs_shap, 6) AS mean_abs_shap
FROM phi p JOIN top t ON p.feature = t.feature""")
    sql["strongest_case"] = with_views(SCORED, """
SELECT model_name, event_id, y, score FROM scored WHERE model_name = 'model_a'
ORDER BY CASE WHEN y = 1 THEN 0 ELSE 1 END, score DESC, event_id LIMIT 1""")
    sql["geolocation_job_rates"] = sql["geo_country_rates"]
    sql["feature_job_facts"] = with_views(GEO, """
SELECT count(*) AS n, cast(sum(class) AS bigint) AS fraud,
       11 + count(DISTINCT source) + count(DISTINCT browser) + count(DISTINCT sex) + count(DISTINCT country) AS features FROM geo""")
    sql["resampling_job_balance"] = with_views(TXN + "," + split_counts("txn"), """
SELECT 'train_before_resampling' AS stage, class, train_n AS count FROM want UNION ALL
SELECT 'train_after_resampling', class, (SELECT min(train_n) FROM want) FROM want UNION ALL
SELECT 'test_holdout_unmodified', class, cast(n - train_n AS bigint) FROM want""")
    sql["strongest_case_per_model"] = with_views(SCORED, """
SELECT model_name, event_id, y, score FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY y DESC, score DESC, event_id) AS n FROM scored) WHERE n = 1""")
    # Models: what follows from the split alone.
    sql["tree_shap_gap"] = with_views(TXN + "," + split_counts("txn"), f"""
SELECT t.event_id, cast(0 AS double) AS gap
FROM (SELECT event_id, class, row_number() OVER (PARTITION BY class ORDER BY {digest("42", "event_id")}) AS n FROM txn) t
JOIN want w ON t.class = w.class WHERE t.n > w.train_n""")
    sql["boosted_shap_gap"] = with_views(TXN + "," + split_counts("txn") + f""",
held AS (
  SELECT t.event_id FROM (
    SELECT event_id, class, row_number() OVER (PARTITION BY class ORDER BY {digest("42", "event_id")}) AS n FROM txn) t
  JOIN want w ON t.class = w.class WHERE t.n > w.train_n)""", f"""
SELECT event_id, cast(0 AS double) AS gap FROM held ORDER BY {digest("43", "event_id")} LIMIT 300""")
    sql["trained_holdout_counts"] = with_views(TXN + "," + split_counts("txn"), """
SELECT 'logistic_regression' AS model_name, sum(n - train_n) FILTER (WHERE class = 1)::bigint AS fraud,
       sum(n - train_n) FILTER (WHERE class = 0)::bigint AS legit, max(train_n)::bigint AS train_fraud, max(train_n)::bigint AS train_legit FROM want""")
    sql["importance_facts"] = with_views(ENGINEERED + "," + matrix(NUMERIC, CATEGORICAL, "eng"), """
SELECT category, count(*) AS features, cast(1 AS double) AS all_importance FROM (
  SELECT DISTINCT feature, CASE WHEN feature IN ('time_since_signup_hours', 'hour_of_day', 'day_of_week', 'age') THEN 'behavioral_timing'
       WHEN feature LIKE 'country\\_%' ESCAPE '\\' THEN 'geography'
       WHEN feature LIKE 'source\\_%' ESCAPE '\\' THEN 'acquisition_channel'
       WHEN feature LIKE 'browser\\_%' ESCAPE '\\' THEN 'device_browser'
       WHEN feature = 'purchase_value' THEN 'transaction_value' ELSE 'other' END AS category FROM matrix)
GROUP BY category""")
    sql["insight_facts"] = with_views(COMPARED + "," + matrix(("purchase_value", "age"), ("source", "browser", "sex"), "txn") + """,
importance AS (SELECT feature, abs(avg(value) FILTER (WHERE class = 1) - avg(value) FILTER (WHERE class = 0)) AS importance
               FROM matrix GROUP BY feature),
top AS (SELECT * FROM importance ORDER BY round(importance, 9) DESC, feature LIMIT 10),
best AS (SELECT * FROM compared ORDER BY pr_auc DESC, model_name LIMIT 1)""", f"""
SELECT model_name, {", ".join(f"round({m}, 6) AS {m}" for m in shown)}, {CONFUSION},
       (SELECT round(max(pr_auc), 6) FROM compared WHERE model_name = 'model_b') AS baseline_pr_auc,
       (SELECT feature FROM top ORDER BY round(importance, 9) DESC, feature LIMIT 1) AS top_feature,
       (SELECT round(max(importance), 6) FROM top) AS top_importance,
       (SELECT count(*) FROM top WHERE feature IN ('time_since_signup_hours', 'hour_of_day', 'day_of_week', 'age')) AS timing_features,
       (SELECT count(*) FROM top WHERE feature LIKE 'country%') AS country_features,
       (SELECT count(*) FROM top WHERE feature LIKE 'source%') AS source_features,
       (SELECT count(*) FROM top WHERE feature LIKE 'browser%') AS browser_features,
       (SELECT bool_or(feature = 'source_Direct') FROM top) AS direct_channel_in_top,
       true_positives + false_positives + false_negatives + true_negatives AS holdout_rows FROM best""")
    return sql

"""Registered queries: every operator applied to whole given tables.

Each query is ``(spark, folder) -> DataFrame``. Doubles are rounded at the very end so that
two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.functions.clock import epoch_micros
from txnlens.operators import attribution, cleaning, columns, encoding, importance, profiling, ranking, sampling
from txnlens.operators import segments, smote, training, tuning
from txnlens.operators.correlation import vector_correlations
from txnlens.operators.geolocation import add_ip_integer, attach_country, match_quality
from txnlens.operators.quantiles import quantile_frame
from txnlens.operators.temporal import add_purchase_clock, add_time_since_signup
from txnlens.operators.velocity import add_velocity
from txnlens.plans import modeling, preparation
from txnlens.session import materialize, scratch_path
from txnlens.sources import readers, saved, standins
from txnlens.sources.writers import write_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# Addresses and countries -----------------------------------------------------------------


def _geolocated(spark: SparkSession, folder: str) -> DataFrame:
    return preparation.geolocate(standins.transactions(spark, folder), standins.ip_ranges(spark, folder))


@query
def geo_country(spark: SparkSession, folder: str) -> DataFrame:
    return _geolocated(spark, folder).select("event_id", "ip_address_int", "country")


@query
def geo_country_rates(spark: SparkSession, folder: str) -> DataFrame:
    return segments.rate_by(_geolocated(spark, folder), "country", min_transactions=100)


@query
def geo_match_quality(spark: SparkSession, folder: str) -> DataFrame:
    return match_quality(_geolocated(spark, folder))


@query
def geo_overlapping_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of suppliers overlap; the shuffled form of the lookup is used."""
    lower = F.col("s_suppkey") * 40_000_003 % standins.IP_SPACE
    ranges = standins.given(spark, folder, "supplier").select(
        lower.alias("lower_bound_ip_address"), (lower + 90_000_000).alias("upper_bound_ip_address"),
        F.col("s_name").alias("country"))
    events = add_ip_integer(standins.transactions(spark, folder))
    return attach_country(events, ranges, max_broadcast_ranges=0, salts=4).select("event_id", "country")


@query
def ip_parse(spark: SparkSession, folder: str) -> DataFrame:
    return add_ip_integer(standins.ip_texts(spark, folder), ip_column="ip_text", output_column="ip_int").select(
        "event_id", "ip_int")


@query
def geolocated_table_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Written partitioned by country, then read back."""
    table = _geolocated(spark, folder).select("event_id", "purchase_value", "ip_address_int", "country")
    path = write_table(table, scratch_path(spark, "sink"), "geolocated", partition_by=["country"])
    return readers.read_table(spark, path).groupBy("country").agg(
        F.count("*").alias("n"), F.round(F.sum("purchase_value"), 4).alias("total_value"),
        F.sum("ip_address_int").alias("ip_sum"))


# Jobs from raw files to written results ---------------------------------------------------


def _raw_folder(spark: SparkSession, folder: str) -> str:
    """The stand-in tables as the raw files, with times cut to seconds."""
    path = scratch_path(spark, "raw")
    base = standins.transactions(spark, folder)
    cut = {n: F.substring(F.col(n).cast("string"), 1, 19) for n in preparation.TIMES}
    write_table(base.withColumns(cut).select(*readers.TRANSACTIONS.names), path, readers.TRANSACTIONS_FILE, format="csv")
    write_table(standins.ip_ranges(spark, folder), path, readers.IP_RANGES_FILE, format="csv")
    return path


@query
def geolocation_job_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files, cleaning, country lookup, written table, rates of the table read back."""
    _, country_rates, _ = preparation.geolocation_job(spark, _raw_folder(spark, folder), scratch_path(spark, "processed"))
    return country_rates


@query
def feature_job_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files to the written feature matrix, read back."""
    paths = preparation.feature_job(spark, _raw_folder(spark, folder), scratch_path(spark, "processed"))
    matrix = readers.read_table(spark, paths["features"])
    return matrix.agg(F.count("*").alias("n"), F.sum("class").alias("fraud")).withColumn("features", F.lit(len(matrix.columns) - 1).cast("long"))


@query
def resampling_job_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files to the written class balance of split and thinned rows."""
    engineered = preparation.engineer(preparation.load_base(spark, _raw_folder(spark, folder)), order_key=preparation.ROW_KEY)
    target = scratch_path(spark, "processed")
    modeling.resampling_job(engineered, target, strategy="undersample", key=preparation.ROW_KEY)
    return readers.read_table(spark, f"{target}/class_imbalance_comparison").select("stage", "class", "count")


# Time and velocity -----------------------------------------------------------------------


@query
def temporal_features(spark: SparkSession, folder: str) -> DataFrame:
    table = add_purchase_clock(add_time_since_signup(standins.transactions(spark, folder)))
    return rounded(table, 6, "time_since_signup_hours").select(
        "event_id", "time_since_signup_hours", "hour_of_day", "day_of_week")


def _velocity(table: DataFrame, key: str, windows: tuple[int, ...] = (1, 24, 168), **options) -> DataFrame:
    features = add_velocity(table, order_key=key, windows_hours=windows, **options)
    return rounded(features, 6, "hours_since_last_txn", "user_txn_velocity_per_day").select(
        key, "hours_since_last_txn", "user_cumulative_txn_count", "user_txn_velocity_per_day",
        *[f"txn_count_last_{h}h" for h in windows])


@query
def velocity_txn(spark: SparkSession, folder: str) -> DataFrame:
    return _velocity(standins.transactions(spark, folder), "event_id")


@query
def velocity_as_of_row(spark: SparkSession, folder: str) -> DataFrame:
    return _velocity(standins.transactions(spark, folder), "event_id", as_of_row=True)


@query
def velocity_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders carry whole days, so a customer's orders of one day tie."""
    return _velocity(standins.given(spark, folder, "orders"), "o_orderkey", (24, 720, 8760),
                     user_column="o_custkey", time_column="o_orderdate")


@query
def velocity_hot_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users above 60 rows take the way by stretches, the others the plain window."""
    return _velocity(standins.transactions(spark, folder), "event_id", hot_rows=60, rows_per_stretch=5_000)


@query
def velocity_null_users(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth event has no user and stands alone; users above 60 rows take the way by stretches."""
    table = standins.transactions(spark, folder).withColumn("user_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id")))
    return _velocity(table, "event_id", hot_rows=60, rows_per_stretch=5_000)


@query
def velocity_burst(spark: SparkSession, folder: str) -> DataFrame:
    """Half of all events are one user's within one second, ten instants of it."""
    moved = F.col("event_id") % 2 == 0
    instant = F.expr("timestamp_ntz'2024-01-05 12:00:00' + make_dt_interval(0, 0, 0, cast(event_id * 7919 % 10 AS decimal(18, 6)) / 10)")
    table = standins.transactions(spark, folder).withColumns({
        "user_id": F.when(moved, F.lit(1)).otherwise(F.col("user_id")),
        "purchase_time": F.when(moved, instant.cast("timestamp_ntz")).otherwise(F.col("purchase_time").cast("timestamp_ntz"))})
    return _velocity(table, "event_id", hot_rows=60, rows_per_stretch=5_000)


# Sources, names, types -------------------------------------------------------------------


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    orders = standins.given(spark, folder, "orders")
    path = write_table(orders, scratch_path(spark, "csv"), "orders", format="csv")
    saved = readers.read_csv(spark, path, orders.schema)
    return saved.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                        epoch_micros(F.col("o_orderdate")).alias("order_us"))


@query
def snake_columns(spark: SparkSession, folder: str) -> DataFrame:
    customer = standins.given(spark, folder, "customer").select(
        F.col("c_custkey").alias(" Customer Key "), F.col("c_name").alias("Name ($)"),
        F.col("c_acctbal").alias("Acct  Balance"), F.col("c_mktsegment").alias("Market Segment"))
    return columns.snake_columns(customer)


@query
def coerce_types(spark: SparkSession, folder: str) -> DataFrame:
    table = standins.dirty_transactions(spark, folder).withColumn("signup_number", F.col("signup_time"))
    return columns.coerce(table, {"signup_number": "double", "age": "double", "class": "string"}).select(
        "event_id", "signup_number", "age", "class")


# Cleaning --------------------------------------------------------------------------------


@query
def clean_missing_median(spark: SparkSession, folder: str) -> DataFrame:
    table = standins.dirty_transactions(spark, folder).select("event_id", "purchase_value", "age", "browser", "class")
    filled = cleaning.fill_missing(table, required=["class"], string_fill="unknown", exclude=["event_id"])
    return filled.withColumn("age", F.col("age").cast("double"))


@query
def clean_missing_mean(spark: SparkSession, folder: str) -> DataFrame:
    table = standins.dirty_transactions(spark, folder).select("event_id", "purchase_value", "age", "class")
    return rounded(cleaning.fill_missing(table, numeric_fill="mean"), 6, "purchase_value", "age", "class")


@query
def clean_missing_zero(spark: SparkSession, folder: str) -> DataFrame:
    table = standins.dirty_transactions(spark, folder).select("event_id", "purchase_value", "age", "class")
    return cleaning.fill_missing(table, numeric_fill="zero")


@query
def clean_mode(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.fill_missing(standins.dirty_transactions(spark, folder).select("event_id", "browser"),
                                 string_fill="mode")


@query
def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_duplicates(
        standins.dirty_transactions(spark, folder).select("event_id", "user_id", "browser", "class"))


def _dedup(spark: SparkSession, folder: str, keep: str) -> DataFrame:
    return cleaning.drop_duplicates(
        standins.dirty_transactions(spark, folder).select("user_id", "browser", "event_id", "purchase_value"),
        subset=["user_id", "browser"], keep=keep, order_by=["event_id"])


@query
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return _dedup(spark, folder, "first")


@query
def dedup_last(spark: SparkSession, folder: str) -> DataFrame:
    return _dedup(spark, folder, "last")


@query
def dedup_none(spark: SparkSession, folder: str) -> DataFrame:
    table = standins.dirty_transactions(spark, folder).select("event_id", "user_id", "browser", "purchase_value")
    return cleaning.drop_duplicates(table, subset=["event_id"], keep=False)


def _micros(df: DataFrame) -> DataFrame:
    return df.withColumns({"signup_us": epoch_micros(F.col("signup_time")),
                           "purchase_us": epoch_micros(F.col("purchase_time"))})


@query
def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    table = cleaning.parse_timestamps(standins.dirty_transactions(spark, folder), preparation.TIMES)
    return _micros(table).select("event_id", "signup_us", "purchase_us")


@query
def unparsed_counts(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.unparsed_counts(standins.dirty_transactions(spark, folder), preparation.TIMES)


@query
def clean_fraud_job(spark: SparkSession, folder: str) -> DataFrame:
    return _micros(preparation.clean_transactions(standins.dirty_transactions(spark, folder))).select(
        "event_id", "user_id", "signup_us", "purchase_us", "purchase_value", "age", "browser", "source", "sex",
        "device_id", "ip_address", "class")


@query
def clean_card_job(spark: SparkSession, folder: str) -> DataFrame:
    return preparation.clean_cards(standins.cards(spark, folder))


@query
def clean_ranges_job(spark: SparkSession, folder: str) -> DataFrame:
    """Every supplier gives two rows with the same bounds and padded names; some cells are empty."""
    supplier, key = standins.given(spark, folder, "supplier"), F.col("s_suppkey")
    lower, upper = key * 1000, F.when(key % 9 != 0, key * 1000 + 900)
    first = F.when(key % 7 != 0, F.concat(F.lit("  "), "s_name", F.lit(" ")))
    second = F.concat(F.lit("  "), "s_name", F.lit("b "))
    raw = supplier.select(lower.alias("Lower_Bound_IP_Address"), upper.alias("Upper_Bound_IP_Address"),
                          F.explode(F.array(first, second)).alias("Country"))
    return preparation.clean_ip_ranges(raw)


# Profiles --------------------------------------------------------------------------------


@query
def describe_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profiling.describe_numeric(standins.dirty_transactions(spark, folder)), 4, "mean", "std")


@query
def describe_strings(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.describe_strings(standins.dirty_transactions(spark, folder))


@query
def describe_all(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.describe(standins.dirty_transactions(spark, folder)).select(
        "column", "dtype", "count", "missing", "p50", "unique")


@query
def describe_five(spark: SparkSession, folder: str) -> DataFrame:
    table = preparation.engineer(standins.transactions(spark, folder))
    return profiling.describe_numeric(table, encoding.NUMERIC_FEATURES[:5], digits=2).drop("dtype", "missing")


@query
def missing_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.missing_summary(standins.dirty_transactions(spark, folder))


@query
def column_overview(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.column_overview(standins.dirty_transactions(spark, folder))


@query
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.column_profile(standins.dirty_transactions(spark, folder))


@query
def duplicate_check(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.duplicate_check(standins.dirty_transactions(spark, folder))


@query
def duplicate_check_subset(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.duplicate_check(standins.dirty_transactions(spark, folder), subset=["user_id", "browser"])


@query
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.class_balance(standins.dirty_transactions(spark, folder))


@query
def balance_by_stage(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.balance_by_stage(standins.transactions(spark, folder), stage_column="source")


@query
def stage_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The untouched holdout's part of a table of stages."""
    train, test = sampling.stratified_split(standins.transactions(spark, folder), key="event_id")
    stages = profiling.compare_stages({"train_before_resampling": train, "test_holdout_unmodified": test})
    return profiling.stage_balance(stages, "test_holdout_unmodified").select("class", "count")


# Segments --------------------------------------------------------------------------------


def _timed(spark: SparkSession, folder: str) -> DataFrame:
    return add_purchase_clock(add_time_since_signup(standins.transactions(spark, folder)))


@query
def rate_by_browser(spark: SparkSession, folder: str) -> DataFrame:
    return segments.rate_by(standins.dirty_transactions(spark, folder), "browser")


@query
def rate_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return segments.rates_by_segment(standins.transactions(spark, folder), ["browser", "source", "sex"])


@query
def rate_by_age_band(spark: SparkSession, folder: str) -> DataFrame:
    return segments.rate_by_age_band(standins.transactions(spark, folder))


@query
def rate_by_value_quartile(spark: SparkSession, folder: str) -> DataFrame:
    return segments.rate_by_quantile_band(standins.transactions(spark, folder), "purchase_value")


@query
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    names = ["purchase_value", "age", "time_since_signup_hours", "ip_address", "class"]
    return rounded(segments.correlations(_timed(spark, folder), names), 6, "r")


@query
def corr_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Correlations of all components of the embeddings; every seventh cell of a component is taken as missing."""
    cells = F.transform("embedding", lambda x, j: F.when((F.col("vec_id") + j) % 7 != 0, x.cast("double")))
    table = standins.given(spark, folder, "embeddings").select(cells.alias("v"))
    return rounded(vector_correlations(table, "v"), 6, "r")


@query
def headline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segments.headline_metrics(_timed(spark, folder)), 6, "fraud_rate_pct", "imbalance_ratio",
                   "median_hours_legit", "median_hours_fraud")


@query
def value_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segments.value_kpis(_timed(spark, folder)), 6, "fraud_rate", "median_hours_legit")


@query
def rate_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segments.mean_rate_by(_timed(spark, folder), "hour_of_day"), 6, "fraud_rate")


@query
def rate_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segments.mean_rate_by(standins.transactions(spark, folder), "source"), 6, "fraud_rate")


@query
def top_countries(spark: SparkSession, folder: str) -> DataFrame:
    table = segments.mean_rate_by(_geolocated(spark, folder), "country", min_transactions=200, top=15)
    return rounded(table, 6, "fraud_rate")


@query
def top_categories(spark: SparkSession, folder: str) -> DataFrame:
    return segments.top_values(standins.transactions(spark, folder), "device_id", 8)


@query
def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return segments.class_counts(standins.transactions(spark, folder))


@query
def histogram_capped(spark: SparkSession, folder: str) -> DataFrame:
    return segments.histogram(_timed(spark, folder), "time_since_signup_hours", bins=40, low=0.0, high=720.0,
                              cap=720.0, by="class").select("class", "bin", "count")


@query
def histogram_plain(spark: SparkSession, folder: str) -> DataFrame:
    return segments.histogram(standins.transactions(spark, folder), "purchase_value").select("bin", "count")


@query
def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    table = segments.box_stats(_timed(spark, folder), ["purchase_value", "age", "time_since_signup_hours"])
    return rounded(table, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def quantiles_null_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Bracketed quantiles by a column with null, empty and value-less groups."""
    flag = F.when(F.col("l_returnflag") != "N", F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(F.col("l_returnflag")))
    lines = standins.given(spark, folder, "lineitem").select(
        flag.alias("flag"), F.when(~flag.eqNullSafe("R"), F.col("l_extendedprice")).alias("price"))
    return rounded(quantile_frame(lines, ["price"], [0.25, 0.5], by="flag", exact_rows=1000), 4, "value")


@query
def quantiles_refined(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles of all line items by bracketing, as for tables beyond one buffer."""
    lines = standins.given(spark, folder, "lineitem")
    table = quantile_frame(lines, ["l_quantity", "l_extendedprice"], [0.05, 0.5, 0.95], by="l_returnflag",
                           exact_rows=1000)
    return rounded(table, 4, "value")


@query
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segments.kpis(standins.transactions(spark, folder)), 6, "fraud_rate")


@query
def dataset_kpis(spark: SparkSession, folder: str) -> DataFrame:
    table = segments.dataset_kpis(standins.transactions(spark, folder), features=len(encoding.NUMERIC_FEATURES))
    return rounded(table, 6, "fraud_rate")


# Sampling --------------------------------------------------------------------------------


@query
def split_of_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Train and holdout rows per class where the key has a hundred values and is missing in places."""
    key = F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 100)
    tagged = sampling.with_split(standins.transactions(spark, folder).withColumn("key", key), key="key")
    return tagged.groupBy("class", "split").agg(F.count("*").alias("n"))


@query
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.with_split(standins.transactions(spark, folder).select("event_id", "class"), key="event_id")


@query
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.with_folds(standins.transactions(spark, folder).select("event_id", "class"), key="event_id", folds=3)


@query
def undersample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.undersample(standins.transactions(spark, folder).select("event_id", "class"), key="event_id")


@query
def seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.seeded_sample(standins.transactions(spark, folder).select("event_id"), 2500, key="event_id", seed=7)


@query
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    weighted = sampling.add_class_weight(standins.transactions(spark, folder).select("class"))
    return rounded(weighted.groupBy("class", "weight").agg(F.count("*").alias("n")), 6, "weight")


# Features --------------------------------------------------------------------------------


def _engineered(spark: SparkSession, folder: str) -> DataFrame:
    return preparation.engineer(_geolocated(spark, folder), count_users_in=standins.given(spark, folder, "events"))


@query
def engineered_table(spark: SparkSession, folder: str) -> DataFrame:
    table = _engineered(spark, folder).select(
        "event_id", "user_id", "source", "browser", "sex", "class", "ip_address_int", "country",
        *encoding.NUMERIC_FEATURES)
    return rounded(table, 6, "time_since_signup_hours", "hours_since_last_txn", "user_txn_velocity_per_day")


def _long_matrix(spark: SparkSession, folder: str) -> DataFrame:
    engineered = materialize(_engineered(spark, folder), "engineered")
    return encoding.fit_encoder(engineered).long(engineered, keep=["event_id"])


@query
def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_long_matrix(spark, folder), 6, "value")


@query
def scaled_numerics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_long_matrix(spark, folder), 6, "value").where(F.col("feature").isin(*encoding.NUMERIC_FEATURES))


@query
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    table = standins.transactions(spark, folder)
    encoder = encoding.fit_encoder(table, encoding.FeatureConfig(numeric=("age",)))
    return encoder.wide(table, keep=["event_id"]).drop("age")


@query
def sparse_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that are not zero of a matrix with a column for every device and every user."""
    table = standins.transactions(spark, folder)
    config = encoding.FeatureConfig(numeric=("purchase_value", "age"), categorical=("source", "browser", "device_id", "user_id"))
    return rounded(encoding.fit_sparse_encoder(table, config).long(table, keep=["event_id"]), 6, "value")


@query
def saved_matrix_holdout(spark: SparkSession, folder: str) -> DataFrame:
    """The train rows' matrix built, saved and loaded; the holdout encoded from what was saved."""
    config = encoding.FeatureConfig(numeric=("purchase_value", "age"), categorical=("source", "browser", "sex"))
    tagged = materialize(sampling.with_split(standins.transactions(spark, folder), key="event_id"), "tagged")
    place = scratch_path(spark, "saved-matrix")
    saved.load_or_build_matrix(spark, place, lambda: tagged.where("split = 'train'"), config=config)
    again = saved.load_or_build_matrix(spark, place, lambda: tagged.limit(0), config=config)
    holdout = again.encoder.long(tagged.where("split = 'test'"), keep=["event_id"])
    return rounded(holdout.withColumn("train_rows", F.lit(sum(again.classes.values())).cast("long")), 6, "value")


@query
def feature_labels(spark: SparkSession, folder: str) -> DataFrame:
    sizes = _long_matrix(spark, folder).groupBy("feature").agg(
        F.round(F.avg(F.abs("value")), 6).alias("mean_abs_value"))
    return importance.labelled_features(sizes)


# Metrics ---------------------------------------------------------------------------------


def _predicted(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.predict_at(standins.scored(spark, folder))


@query
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.confusion_table(_predicted(spark, folder), model="model_name")


@query
def threshold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.threshold_metrics(_predicted(spark, folder)), 6, "accuracy", "precision", "recall", "f1")


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.ranking_metrics(standins.scored(spark, folder)), 6, "roc_auc").select("model_name", "roc_auc")


@query
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.ranking_metrics(standins.scored(spark, folder)), 6, "pr_auc").select("model_name", "pr_auc")


@query
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.pr_curve(standins.scored(spark, folder)), 6, "precision", "recall")


@query
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.roc_curve(standins.scored(spark, folder)), 6, "fpr", "tpr")


@query
def no_skill_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.no_skill_baseline(standins.scored(spark, folder)), 6, "baseline_precision")


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.compare_models(standins.scored(spark, folder))


_SHOWN = ("precision", "recall", "f1", "roc_auc", "pr_auc")


@query
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(columns.comparison_columns(_compared(spark, folder)), 6, *_SHOWN)


@query
def metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(columns.metrics_long(_compared(spark, folder), ["precision", "recall", "f1", "pr_auc"]), 6, "score")


@query
def best_model_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.best_model_summary(_compared(spark, folder)), 6, *_SHOWN, "pr_auc_gap_vs_runner_up")


@query
def holdout_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.holdout_rates(_compared(spark, folder)), 6, "fraud_caught_rate", "false_alarm_rate")


# Oversampling ----------------------------------------------------------------------------


@query
def smote_neighbors(spark: SparkSession, folder: str) -> DataFrame:
    rare = standins.vectors(spark, folder).where(F.col("class") == 1)
    return smote.nearest_neighbors(rare, key="vec_id")


@query
def smote_rows(spark: SparkSession, folder: str) -> DataFrame:
    made = smote.smote_rows(standins.vectors(spark, folder), key="vec_id")
    return made.select("synthetic_id", "base", "neighbor", F.round("share", 6).alias("share"),
                       F.posexplode("features").alias("position", "value")).withColumn("value", F.round("value", 5))


@query
def smote_balance(spark: SparkSession, folder: str) -> DataFrame:
    train, test = sampling.stratified_split(standins.vectors(spark, folder), key="vec_id")
    resampled = smote.resample(train, "smote", key="vec_id")
    return profiling.compare_stages({"train_before_resampling": train, "train_after_resampling": resampled,
                                     "test_holdout_unmodified": test})


@query
def smote_neighbors_blocked(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbors among all embeddings, compared block by block."""
    return smote.nearest_neighbors(standins.vectors(spark, folder), key="vec_id", block_rows=256)


@query
def undersample_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The rare toxic label: stratified split, train rows thinned, holdout untouched."""
    labels = standins.given(spark, folder, "labels").select("doc_id", F.col("toxic").alias("class"))
    train, test = sampling.stratified_split(labels, key="doc_id")
    thinned = sampling.undersample(train, key="doc_id")
    return profiling.compare_stages({"train_before_resampling": train, "train_after_resampling": thinned,
                                     "test_holdout_unmodified": test})


# Attribution -----------------------------------------------------------------------------

_VECTOR_NAMES = [f"f{j}" for j in range(64)]
_BETA = [(j * 7 % 13 - 6) / 10 for j in range(64)]


def _linear(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Attributions of a fixed linear model on every embedding, and the embeddings."""
    rows = standins.vectors(spark, folder).select("vec_id", "features")
    background = sampling.seeded_sample(rows, attribution.BACKGROUND_ROWS, key="vec_id")
    means = attribution.background_means(background)
    return attribution.linear_attribution(rows, _BETA, means, _VECTOR_NAMES, key="vec_id"), rows


@query
def linear_shap(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_linear(spark, folder)[0], 6, "phi")


@query
def shap_rank(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(attribution.rank_features(_linear(spark, folder)[0]), 6, "mean_abs_shap", "mean_shap")


@query
def waterfall(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(attribution.waterfall(_linear(spark, folder)[0], key="vec_id"), 6, "phi")


@query
def shap_dependence(spark: SparkSession, folder: str) -> DataFrame:
    values, rows = _linear(spark, folder)
    top = attribution.rank_features(values, top_n=1).first()["feature"]
    return rounded(attribution.dependence(values, rows, _VECTOR_NAMES, top, key="vec_id"), 6, "value", "phi").select(
        "vec_id", "feature", "value", "phi")


@query
def shap_beeswarm(spark: SparkSession, folder: str) -> DataFrame:
    values, rows = _linear(spark, folder)
    return rounded(attribution.beeswarm(values, rows, _VECTOR_NAMES, key="vec_id"), 6, "value", "phi",
                   "mean_abs_shap").select("vec_id", "feature", "value", "phi", "mean_abs_shap")


@query
def strongest_case(spark: SparkSession, folder: str) -> DataFrame:
    strong = standins.scored(spark, folder).where(F.col("model_name") == "model_a")
    return attribution.strongest_case(strong, key="event_id").select("model_name", "event_id", "y", "score")


@query
def strongest_case_per_model(spark: SparkSession, folder: str) -> DataFrame:
    scored = standins.scored(spark, folder)
    return columns.stack_rows([
        attribution.strongest_case(scored.where(F.col("model_name") == name), key="event_id").select("model_name", "event_id", "y", "score")
        for name in ("model_a", "model_b")])


@query
def insight_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Importance here is the gap between the class means of a scaled feature."""
    table = standins.transactions(spark, folder)
    encoder = encoding.fit_encoder(table, encoding.FeatureConfig(numeric=("purchase_value", "age")))
    of_class: Callable[[int], Column] = lambda c: F.avg(F.when(F.col("class") == c, F.col("value")))
    gaps = encoder.long(table, keep=["event_id", "class"]).groupBy("feature").agg(
        F.round(F.abs(of_class(1) - of_class(0)), 9).alias("importance"))
    facts = importance.insight_facts(_compared(spark, folder), gaps, baseline="model_b")
    return rounded(facts.drop("accuracy"), 6, *_SHOWN, "baseline_pr_auc", "top_importance")


# Models: no SQL form, tests check their invariants ---------------------------------------

_SMALL_SEARCHES = {
    "logistic_regression": tuning.SEARCHES["logistic_regression"],
    "random_forest": ("random", {"numTrees": [10, 20], "maxDepth": [4, 6], "minInstancesPerNode": [1, 5]}),
}


def _prepared(spark: SparkSession, folder: str) -> modeling.PreparedData:
    return modeling.prepare(materialize(_engineered(spark, folder), "engineered"))


def _fitted(spark: SparkSession, folder: str, name: str, **settings) -> tuple[training.TrainedModel, modeling.PreparedData]:
    """A default model, but for ``settings``, fitted on the original train rows."""
    data = _prepared(spark, folder)
    estimator = training.default_estimator(name, rows=data.train.count())
    estimator = estimator.copy({estimator.getParam(p): v for p, v in settings.items()})
    return training.train_model(name, data.train, data.test, key="event_id", estimator=estimator), data


def _forest(spark: SparkSession, folder: str) -> tuple[training.TrainedModel, modeling.PreparedData]:
    """A hundred trees at the shallowest depth of the search space; unbounded ones take minutes to fit."""
    return _fitted(spark, folder, "random_forest", maxDepth=12)


@query
def train_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Three model families on the oversampled train rows, compared on the whole holdout."""
    data = modeling.resample_train(_prepared(spark, folder))
    return training.compare_trained(training.train_models(
        training.MODEL_NAMES, data.train_resampled, data.prepared.test, key="event_id"))


@query
def tune_summary(spark: SparkSession, folder: str) -> DataFrame:
    data = _prepared(spark, folder)
    return tuning.tuning_summary(spark, [
        tuning.tune_model(name, data.train, key="event_id", search=search, draws=3)
        for name, search in _SMALL_SEARCHES.items()])


@query
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    forest, data = _forest(spark, folder)
    return importance.labelled_features(importance.feature_importance(spark, forest.model, data.encoder.names))


@query
def coefficient_extremes(spark: SparkSession, folder: str) -> DataFrame:
    data = _prepared(spark, folder)
    fitted = training.train_model("logistic_regression", data.train, data.test, key="event_id")
    table = importance.feature_importance(spark, fitted.model, data.encoder.names)
    return columns.stack_rows(importance.coefficient_extremes(table))


def _explained(forest: training.TrainedModel, data: modeling.PreparedData) -> DataFrame:
    values, base = attribution.tree_attribution(data.test, forest.model, data.encoder.names, key="event_id")
    totals = values.groupBy("event_id").agg((F.sum("phi") + F.lit(base)).alias("explained"))
    return totals.join(forest.scores.select("event_id", "score"), "event_id")


@query
def tree_shap(spark: SparkSession, folder: str) -> DataFrame:
    """Attributions of the whole holdout next to score and expected score."""
    return _explained(*_forest(spark, folder))


@query
def tree_shap_gap(spark: SparkSession, folder: str) -> DataFrame:
    """Attributions of every holdout row miss the score of the default forest by nothing."""
    return _explained(*_fitted(spark, folder, "random_forest")).select(
        "event_id", F.round(F.abs(F.col("explained") - F.col("score")), 6).alias("gap"))


@query
def trained_holdout_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Class counts of the untouched holdout as a model fitted on oversampled rows was scored on it."""
    data = modeling.resample_train(_prepared(spark, folder))
    fitted = training.train_model("logistic_regression", data.train_resampled, data.prepared.test, key="event_id")
    sizes = sampling.class_sizes(data.train_resampled, "class")
    return fitted.metrics.select(
        "model_name", (F.col("true_positives") + F.col("false_negatives")).alias("fraud"),
        (F.col("false_positives") + F.col("true_negatives")).alias("legit"),
        F.lit(sizes[1]).cast("long").alias("train_fraud"), F.lit(sizes[0]).cast("long").alias("train_legit"))


@query
def importance_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Features of the forest's importance table by category, and their whole."""
    table = feature_importance(spark, folder)
    whole = table.agg(F.round(F.sum("importance"), 6)).first()[0]
    return table.groupBy("category").agg(F.count("*").alias("features")).withColumn("all_importance", F.lit(whole))


def _boosted_pair(spark: SparkSession, folder: str) -> tuple[training.TrainedModel, list[str], DataFrame, DataFrame]:
    """Default boosted trees, feature names, the background sample and the holdout rows to explain."""
    fitted, data = _fitted(spark, folder, "gradient_boosted_trees")
    background, rows = attribution.sample_pair(data.train, data.test, key="event_id")
    return fitted, data.encoder.names, materialize(background, "background"), materialize(rows, "explained")


@query
def sampled_shap(spark: SparkSession, folder: str) -> DataFrame:
    """Model-agnostic attributions of boosted trees over the whole background, ranked."""
    fitted, names, background, rows = _boosted_pair(spark, folder)
    return attribution.rank_features(attribution.sampled_attribution(rows, background, fitted.model, names, key="event_id", permutations=1))


@query
def boosted_shap_gap(spark: SparkSession, folder: str) -> DataFrame:
    """Attributions of boosted trees over the whole background miss the explained rows' scores by nothing."""
    fitted, names, background, rows = _boosted_pair(spark, folder)
    values, base = attribution.boosted_attribution(rows, background, fitted.model, names, key="event_id")
    totals = values.groupBy("event_id").agg((F.sum("phi") + F.lit(base)).alias("explained"))
    return totals.join(fitted.scores.select("event_id", "score"), "event_id").select(
        "event_id", F.round(F.abs(F.col("explained") - F.col("score")), 6).alias("gap"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)

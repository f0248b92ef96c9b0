"""Wall seconds of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry.queries import queries  # noqa: E402
from txnlens.session import build_session, scratch  # noqa: E402

HEADLINE = (
    "geo_country", "geo_country_rates", "geo_overlapping_ranges", "ip_parse", "temporal_features", "velocity_txn",
    "velocity_orders", "velocity_hot_users", "clean_fraud_job", "clean_card_job", "dedup_first", "describe_numeric",
    "describe_strings", "missing_summary", "duplicate_check", "class_balance", "rate_by_segment",
    "rate_by_value_quartile", "corr_matrix", "box_stats", "stratified_split", "undersample", "engineered_table",
    "feature_matrix", "model_comparison", "pr_curve", "smote_neighbors", "smote_rows", "linear_shap", "shap_rank",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    cold, warm = {}, {}
    for timings in (cold, warm):
        for name in HEADLINE:
            start = time.perf_counter()
            with scratch(spark):
                # A sink that reads every value of every column.
                known[name](spark, folder).write.format("noop").mode("overwrite").save()
                timings[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of warm wall seconds over headline queries", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": Path(folder).name.removeprefix("sf"), "cpus": cpus}))


if __name__ == "__main__":
    main()

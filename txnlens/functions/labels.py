"""Readable names for features and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The output texts below must stay as they are, reports match on them.
INCREASES = "increases_fraud_risk"
DECREASES = "decreases_fraud_risk"
CLASS_NAMES = {0: "Legitimate", 1: "Fraud"}
FEATURE_TEXT = {
    "purchase_value": "higher purchase amounts",
    "age": "customer age",
    "time_since_signup_hours": "short time between signup and purchase",
    "hour_of_day": "purchase hour of day",
    "day_of_week": "purchase day of week",
    "txn_count_last_1h": "many transactions in the last hour",
    "txn_count_last_24h": "many transactions in the last 24 hours",
    "txn_count_last_168h": "many transactions in the last week",
    "hours_since_last_txn": "time since the user's previous transaction",
    "user_cumulative_txn_count": "user transaction history volume",
    "user_txn_velocity_per_day": "high daily transaction velocity",
}
PREFIX_TEXT = {
    "country_": ("transactions from ", ""),
    "browser_": ("using ", " browser"),
    "source_": ("traffic from ", " channel"),
    "sex_": ("customer sex = ", ""),
}
PREFIX_CATEGORY = {
    "country_": "geography",
    "source_": "acquisition_channel",
    "browser_": "device_browser",
}
TIMING_FEATURES = ("time_since_signup_hours", "hour_of_day", "day_of_week", "age")


def direction(signed: Column) -> Column:
    return F.when(signed > 0, F.lit(INCREASES)).otherwise(F.lit(DECREASES))


def class_name(label: Column) -> Column:
    chosen = F.lit(None).cast("string")
    for code, name in CLASS_NAMES.items():
        chosen = F.when(label == code, F.lit(name)).otherwise(chosen)
    return chosen


def feature_text(feature: Column) -> Column:
    """Plain-language phrase for a feature name; unknown names lose their underscores."""
    known = F.create_map(*[F.lit(x) for pair in FEATURE_TEXT.items() for x in pair])
    text = F.coalesce(F.try_element_at(known, feature), F.replace(feature, F.lit("_"), F.lit(" ")))
    for prefix, (before, after) in PREFIX_TEXT.items():
        value = F.substr(feature, F.lit(len(prefix) + 1))
        if prefix == "country_":
            value = F.replace(value, F.lit("_"), F.lit(" "))
        text = F.when(feature.startswith(prefix), F.concat(F.lit(before), value, F.lit(after))).otherwise(text)
    return text


def feature_category(feature: Column) -> Column:
    chosen = (
        F.when(feature.isin(*TIMING_FEATURES), F.lit("behavioral_timing"))
        .when(feature == "purchase_value", F.lit("transaction_value"))
    )
    for prefix, category in PREFIX_CATEGORY.items():
        chosen = chosen.when(feature.startswith(prefix), F.lit(category))
    return chosen.otherwise(F.lit("other"))

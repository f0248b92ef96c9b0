"""Signup and purchase time features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.functions.checks import require_columns
from txnlens.functions.clock import day_of_week, hour_of_day, hours_between


def add_time_since_signup(df: DataFrame, *, signup_column: str = "signup_time",
                          purchase_column: str = "purchase_time",
                          output_column: str = "time_since_signup_hours") -> DataFrame:
    """Hours from signup to purchase; negative when the purchase came first."""
    require_columns(df, [signup_column, purchase_column])
    return df.withColumn(output_column, hours_between(F.col(signup_column), F.col(purchase_column)))


def add_purchase_clock(df: DataFrame, *, purchase_column: str = "purchase_time",
                       hour_column: str = "hour_of_day", day_column: str = "day_of_week") -> DataFrame:
    """Hour 0-23 and weekday with Monday as 0."""
    require_columns(df, [purchase_column])
    return df.withColumns({
        hour_column: hour_of_day(F.col(purchase_column)),
        day_column: day_of_week(F.col(purchase_column)),
    })

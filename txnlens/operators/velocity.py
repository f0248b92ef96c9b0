"""Per-user transaction frequency over trailing time windows.

A user with an ordinary number of rows is one window partition: all features share one
exchange and one sort. A hot user would put a third of the table into one task, so users
above ``hot_rows`` go another way: their timelines are cut into stretches of equally many rows,
wherever that is, within a burst of one instant too; running counts carry the totals of
earlier stretches, and a trailing count is the difference of two running counts. Both ways give
the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.functions.checks import require_columns
from txnlens.functions.clock import MICROS_PER_HOUR, epoch_micros
from txnlens.operators.running import ROWS_PER_STRETCH, running_sums
from txnlens.session import materialize

DEFAULT_WINDOWS_HOURS = (1, 24, 168)
# Users active for less than an hour count as active for one hour.
SHORTEST_ACTIVE_DAYS = 1.0 / 24.0


def add_velocity(df: DataFrame, *, user_column: str = "user_id", time_column: str = "purchase_time",
                 order_key: str = "event_id", windows_hours: Iterable[int] = DEFAULT_WINDOWS_HOURS,
                 as_of_row: bool = False, hot_rows: int | None = 20_000_000,
                 rows_per_stretch: int = ROWS_PER_STRETCH, count_users_in: DataFrame | None = None) -> DataFrame:
    """Add gap to the previous purchase, running count, daily rate and trailing counts.

    ``order_key`` orders purchases of one instant; rows that share it follow in any order. A row
    without a user is a user of its own. The daily rate
    divides by the user's whole active span, which looks ahead; ``as_of_row=True`` divides by
    the span up to the row. Trailing counts include both ends and all ties. ``hot_rows=None``
    skips the search for hot users. The search counts rows per user in ``count_users_in``,
    by default ``df``: hand over the table from before the joins to keep it a one-column scan.
    """
    require_columns(df, [user_column, time_column, order_key])
    windows = list(windows_hours)
    timed = df.withColumn("_at", epoch_micros(F.col(time_column)))
    plain = _by_user_window(timed, user_column, order_key, windows)
    if hot_rows is not None:
        # At most rows / hot_rows users can be this large, which bounds the broadcast below.
        counted = df if count_users_in is None else count_users_in
        hot_users = counted.where(F.col(user_column).isNotNull()).groupBy(user_column).count().where(
            F.col("count") > hot_rows).select(user_column)
        if not hot_users.isEmpty():
            # Written once: the hot rows are read several times.
            hot_users = F.broadcast(materialize(hot_users, "hot-users"))
            cold = timed.join(hot_users, user_column, "left_anti")
            # The row number, fixed once written, keeps rows apart that share an order key.
            hot = timed.join(hot_users, user_column, "left_semi").withColumn("_row", F.monotonically_increasing_id())
            hot = materialize(hot, "hot-rows")
            plain = _by_user_window(cold, user_column, order_key, windows).drop("_alone").unionByName(
                _by_stretches(hot, user_column, order_key, windows, rows_per_stretch).drop("_row"))
    rate = _daily_rate(F.col("_index"), F.col("_first"), F.col("_at") if as_of_row else F.col("_last"))
    return plain.select(
        *df.columns,
        F.coalesce((F.col("_at") - F.col("_previous")).cast("double") / F.lit(float(MICROS_PER_HOUR)),
                   F.lit(0.0)).alias("hours_since_last_txn"),
        F.col("_index").alias("user_cumulative_txn_count"),
        rate.alias("user_txn_velocity_per_day"),
        *[_trailing(h).alias(f"txn_count_last_{h}h") for h in windows],
    )


def _trailing(hours: int) -> Column:
    """A row without a time counts nothing, unless it is the user's only row."""
    lone = F.col("_at").isNull() & (F.col("_size") == 1)
    return F.when(lone, F.lit(1)).otherwise(F.col(f"_within_{hours}")).cast("long")


def _daily_rate(index: Column, first: Column, last: Column) -> Column:
    days = (last - first).cast("double") / F.lit(24.0 * MICROS_PER_HOUR)
    return index.cast("double") / F.when(days.isNotNull(), F.greatest(days, F.lit(SHORTEST_ACTIVE_DAYS)))


def _by_user_window(timed: DataFrame, user: str, key: str, windows: list[int]) -> DataFrame:
    alone = F.when(F.col(user).isNull(), F.struct(key, F.monotonically_increasing_id().alias("row")))
    timed = timed.withColumn("_alone", alone)
    whole = W.partitionBy(user, "_alone")
    timeline = whole.orderBy(F.col("_at").asc_nulls_last())
    ranked = whole.orderBy(F.col("_at").asc_nulls_last(), key)
    # The finest order first: the range frames below reuse its sort.
    indexed = timed.select(
        "*",
        F.row_number().over(ranked).cast("long").alias("_index"),
        F.lag("_at").over(ranked).alias("_previous"),
    )
    return indexed.select(
        "*",
        *[F.count("_at").over(timeline.rangeBetween(-h * MICROS_PER_HOUR, W.currentRow)).alias(f"_within_{h}")
          for h in windows],
        F.min("_at").over(whole).alias("_first"),
        F.max("_at").over(whole).alias("_last"),
        F.count("*").over(whole).alias("_size"),
    )


def _by_stretches(timed: DataFrame, user: str, key: str, windows: list[int], rows_per_stretch: int) -> DataFrame:
    """The columns of ``_by_user_window`` from running counts.

    Every row becomes its event, a point after all events of its instant, and a point before all events of each window's
    first instant; the events counted at these points give its index, its ties and what lies before its windows. Rows
    without a time sort last.
    """
    end_of_time = F.lit(2**62)
    before, event, after = F.lit(0), F.lit(1), F.lit(2)
    at = F.coalesce("_at", end_of_time)
    points = timed.select(user, key, "_row", F.inline(F.array(
        F.struct(at.alias("at"), event.alias("kind"), F.lit(0).alias("hours")), F.struct(at.alias("at"), after.alias("kind"), F.lit(0).alias("hours")),
        *[F.struct((F.col("_at") - h * MICROS_PER_HOUR).alias("at"), before.alias("kind"), F.lit(h).alias("hours")) for h in windows],
    ))).where(F.col("at").isNotNull())
    is_event = F.col("kind") == 1
    running = running_sums(
        points, [user], ["at", "kind", key, "_row"], {"upto": is_event.cast("long")},
        latest={"previous": F.when(is_event & (F.col("at") < end_of_time), F.col("at"))}, rows_per_stretch=rows_per_stretch, label="velocity")
    counts = running.groupBy(user, "_row").agg(
        F.max(F.when(is_event, F.col("upto"))).alias("_index"), F.max(F.when(is_event, F.col("previous"))).alias("_previous"),
        F.max(F.when(F.col("kind") == 2, F.col("upto"))).alias("_reached"),
        *[F.max(F.when((F.col("kind") == 0) & (F.col("hours") == h), F.col("upto"))).alias(f"_before_{h}") for h in windows])
    spans = timed.groupBy(user).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("_size"))
    return (
        timed.join(counts, [user, "_row"]).join(F.broadcast(spans), user)
        .select(*timed.columns, "_index", "_previous",
                *[F.when(F.col("_at").isNull(), F.lit(0)).otherwise(F.col("_reached") - F.col(f"_before_{h}"))
                  .alias(f"_within_{h}") for h in windows],
                "_first", "_last", "_size")
    )

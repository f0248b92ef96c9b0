"""Running sums over ordered groups of any size, without a window per group.

Rows are range-partitioned by (group, order) and sorted, so a partition holds a stretch of the order whatever the
groups' sizes are. A first pass adds up inside each stretch and the table is written. A group that goes on from one
stretch into the next gets the totals of its earlier stretches added; there is at most one such group a partition, so
the table of these totals has no more rows than there are partitions.

Rows equal in group and order are dealt apart by their place in the input, which therefore should be a written table
or a plan that gives the same rows in the same order when a task runs again. Sums of longs are exact; sums of doubles
are sums in order. Null groups are a group of their own, null values count as 0, an empty table stays empty. Column
names that begin with ``__`` are taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.session import materialize

#: Most rows of one stretch; the number of partitions follows from it.
ROWS_PER_STRETCH = 500_000
#: Smaller tables get as many stretches as the session has shuffle partitions, but none of fewer rows than this.
LEAST_ROWS = 20_000


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], sums: dict[str, Column], *,
                 latest: dict[str, Column] | None = None, n_rows: int | None = None,
                 rows_per_stretch: int = ROWS_PER_STRETCH, label: str = "running") -> DataFrame:
    """``df`` with, for every name of ``sums``, the sum of its column over the group's rows up to and with this one.

    ``latest`` adds the last value that is not null in the group's rows before this one. ``order`` takes names and sort
    expressions. Rows with equal order come in any order, each with its own running value. ``n_rows`` spares a count.
    """
    latest = latest or {}
    if not group:
        raise ValueError("running_sums needs a group column; use a constant for one group")
    rows = df.count() if n_rows is None else n_rows
    spread = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // LEAST_ROWS)
    stretches = max(1, spread, -(-rows // rows_per_stretch))
    keys = [*group, *order, "__tie"]
    sorted_rows = (
        df.select("*", *[c.alias(n) for n, c in sums.items()], *[c.alias(n) for n, c in latest.items()],
                  *[c.alias(f"__own_{n}") for n, c in latest.items()], F.monotonically_increasing_id().alias("__tie"))
        .repartitionByRange(stretches, *keys).sortWithinPartitions(*keys).drop("__tie")
        .select("*", F.spark_partition_id().alias("__part"), F.lit(1).cast("long").alias("__count"), F.lit(False).alias("__first")))
    totals = [*sums, "__count"]
    local = materialize(sorted_rows.mapInArrow(_within_stretch(tuple(group), tuple(totals), tuple(latest)), sorted_rows.schema), label)
    earlier = _earlier_totals(local, list(group), totals, list(latest))
    here = [F.col(f"l.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [*group, "__part"]]
    joined = local.alias("l").join(F.broadcast(earlier.alias("e")), _all(here), "left")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns],
                         *[(F.col(f"l.{n}") + F.coalesce(F.col(f"e.{n}"), F.lit(0))).alias(n) for n in sums],
                         *[F.coalesce(F.col(f"l.{n}"), F.col(f"e.{n}")).alias(n) for n in latest])


def _earlier_totals(local: DataFrame, group: list[str], totals: list[str], latest: list[str]) -> DataFrame:
    """What came before, for groups that go on from an earlier stretch; at most one row a partition."""
    opening = local.where("__first").select(*group).distinct()
    same = _all([F.col(f"l.{c}").eqNullSafe(F.col(f"o.{c}")) for c in group])
    of_stretch = (
        local.alias("l").join(F.broadcast(opening.alias("o")), same, "left_semi")
        .groupBy(*group, "__part").agg(F.max_by(F.struct(*totals), "__count").alias("__last"), *[
            F.max_by(f"__own_{n}", F.when(F.col(f"__own_{n}").isNotNull(), F.col("__count"))).alias(n) for n in latest]))
    before = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    return of_stretch.select(*group, "__part", *[F.sum(f"__last.{n}").over(before).alias(n) for n in totals],
                             *[F.last(n, ignorenulls=True).over(before).alias(n) for n in latest]).where(
        F.col("__count").isNotNull())


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _within_stretch(group: tuple[str, ...], totals: tuple[str, ...],
                    latest: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        carry: dict[str, object] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            fresh = np.zeros(n, dtype=bool)
            for name in group:
                fresh[1:] |= changes(batch.column(name))
            opening = last is None
            fresh[0] = opening or last != tuple(batch.column(c)[0].as_py() for c in group)
            starts = np.flatnonzero(fresh)
            if not fresh[0]:
                starts = np.concatenate([[0], starts])
            lengths = np.diff(np.append(starts, n))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for name in totals:
                values = columns[name].fill_null(0).to_numpy(zero_copy_only=False)
                if not fresh[0]:
                    values = values.copy()
                    values[0] += carry[name]
                sums = np.cumsum(values)
                sums = sums - np.repeat(sums[starts] - values[starts], lengths)
                carry[name] = sums[-1]
                columns[name] = pa.array(sums, type=batch.schema.field(name).type)
            for name in latest:
                own = columns[f"__own_{name}"]
                place = np.maximum.accumulate(np.where(own.is_valid().to_numpy(zero_copy_only=False), np.arange(n), -1))
                before = np.append(-1, place[:-1])
                start = np.repeat(starts, lengths)
                values = own.take(pa.array(before, mask=before < start))
                if not fresh[0]:
                    carried = (before < 0) & (start == 0)
                    values = pc.if_else(pa.array(carried), pa.scalar(carry[name], type=own.type), values)
                columns[name] = values
                # For the next batch: the last value of the group that the last row belongs to.
                carry[name] = own[int(place[-1])].as_py() if place[-1] >= starts[-1] else (
                    None if fresh[starts[-1]] else carry[name])
            columns["__first"] = pa.array(np.arange(n) == 0 if opening else np.zeros(n, dtype=bool))
            last = tuple(batch.column(c)[n - 1].as_py() for c in group)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)
    return run


def changes(column: pa.Array) -> np.ndarray:
    """Whether each value after the first differs from the one before it; null equals null."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    unequal = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return unequal | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))


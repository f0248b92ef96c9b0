"""Exact quantiles with linear interpolation, at any table size.

``percentile`` keeps every distinct value of a group in one buffer, which is right for small
groups only. Above ``exact_rows`` rows the wanted ranks are bracketed with the mergeable
``percentile_approx`` sketch, the rows inside the brackets are counted exactly, and the
brackets shrink about fiftyfold per pass. Ranks are read off once few values are left.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.checks import present, require_columns

EXACT_ROWS = 5_000_000
_GRID = 200
_SKETCH_ACCURACY = 10_000
# Brackets are not narrowed below this many rows.
_FEWEST = 50


def quantile_frame(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *,
                   by: str | None = None, approx: int | None = None,
                   exact_rows: int = EXACT_ROWS, rows: int | None = None) -> DataFrame:
    """Long table ([``by``], ``column``, ``p``, ``value``). ``by`` must have few groups.

    ``approx`` is the accuracy of ``percentile_approx`` and skips exactness. ``rows`` saves
    the counting pass when the caller knows the size.
    """
    require_columns(df, [*columns, *([by] if by else [])])
    data = df.select(*([F.col(by)] if by else []), *[present(df, c).cast("double").alias(c) for c in columns])
    # All columns share one buffer per group, so cells are bounded as well as rows.
    most = min(exact_rows, 4 * exact_rows // max(1, len(columns)))
    if approx is None and (data.count() if rows is None else rows) > most:
        return _refined(data, list(columns), list(probabilities), by, exact_rows)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    if approx is None:
        values = {c: F.percentile(c, wanted) for c in columns}
    else:
        values = {c: F.percentile_approx(c, wanted, approx) for c in columns}
    grouped = data.groupBy(by) if by else data.groupBy()
    wide = grouped.agg(*[v.alias(c) for c, v in values.items()])
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("p"), F.try_element_at(c, F.lit(i + 1)).alias("value"))
        for c in columns for i, p in enumerate(probabilities)
    ]
    return wide.select(*([by] if by else []), F.inline(F.array(*cells)))


def quantile_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    **kwargs) -> dict[str, list[float | None]]:
    """The same as ``{column: [value per probability]}``: columns times probabilities numbers."""
    if not columns:
        return {}
    found = {(r["column"], r["p"]): r["value"]
             for r in quantile_frame(df, columns, probabilities, **kwargs).collect()}
    return {c: [found.get((c, float(p))) for p in probabilities] for c in columns}


def _refined(data: DataFrame, columns: list[str], probabilities: list[float],
             by: str | None, exact_rows: int) -> DataFrame:
    targets = [(c, p) for c in columns for p in probabilities]
    # Groups get numbers, so that null, empty text and groups without values stay apart.
    counts = [F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)]
    found = (data.groupBy(by) if by else data.groupBy()).agg(*counts).collect()
    sizes = {g: {c: r[f"_n{i}"] for i, c in enumerate(columns)} for g, r in enumerate(found)}
    keyed = data.withColumn("_group", F.lit(0))
    if by:
        kind = T.StructType([T.StructField("_by", data.schema[by].dataType), T.StructField("_group", T.IntegerType())])
        groups = data.sparkSession.createDataFrame([(r[by], g) for g, r in enumerate(found)], kind)
        keyed = data.join(F.broadcast(groups), data[by].eqNullSafe(groups["_by"])).drop("_by")
    ranks = {(g, c, p): p * (n[c] - 1) for g, n in sizes.items() for c, p in targets if n[c]}
    brackets = {key: (-math.inf, math.inf) for key in ranks}
    # Per target: values below its bracket, in it, and strictly inside.
    seen = {(g, c, p): (0, sizes[g][c], sizes[g][c]) for g, c, p in ranks}
    low, high = [f"_low{i}" for i in range(len(targets))], [f"_high{i}" for i in range(len(targets))]
    schema = ", ".join(["_group int", *[f"{name} double" for pair in zip(low, high, strict=True) for name in pair]])

    def bracketed() -> DataFrame:
        """The data with its group's current brackets: one small row per group."""
        rows = [(g, *[limit for t in targets for limit in brackets.get((g, *t), (None, None))]) for g in sizes]
        return keyed.join(F.broadcast(data.sparkSession.createDataFrame(rows, schema)), "_group")

    def inside(i: int) -> Column:
        return F.col(targets[i][0]).between(F.col(low[i]), F.col(high[i]))

    def survey() -> dict:
        counts = []
        for i, (c, _) in enumerate(targets):
            strictly = (F.col(c) > F.col(low[i])) & (F.col(c) < F.col(high[i]))
            counts += [F.count_if(F.col(c) < F.col(low[i])).alias(f"below{i}"),
                       F.count_if(inside(i)).alias(f"in{i}"), F.count_if(strictly).alias(f"strict{i}")]
        rows = bracketed().groupBy("_group").agg(*counts).collect()
        return {(r["_group"], *t): (r[f"below{i}"], r[f"in{i}"], r[f"strict{i}"])
                for r in rows for i, t in enumerate(targets) if (r["_group"], *t) in ranks}

    grid = F.array(*[F.lit(i / _GRID) for i in range(_GRID + 1)])
    few = max(exact_rows, _FEWEST)
    while max((s[2] for s in seen.values()), default=0) > few:
        sketches = bracketed().groupBy("_group").agg(*[
            F.percentile_approx(F.when(inside(i), F.col(c)), grid, _SKETCH_ACCURACY).alias(f"s{i}")
            for i, (c, _) in enumerate(targets)]).collect()
        for row in sketches:
            for i, target in enumerate(targets):
                key = (row["_group"], *target)
                if key not in ranks or seen[key][2] <= few:
                    continue
                below, within, _ = seen[key]
                place = (ranks[key] - below) / max(within - 1, 1) * _GRID
                # One step covers the sketch's error, the rest two whole rows on either side.
                margin = 1 + math.ceil(2 * _GRID / within)
                first, last = math.floor(place) - margin, math.ceil(place) + margin
                brackets[key] = (row[f"s{i}"][first] if first >= 0 else brackets[key][0],
                                 row[f"s{i}"][last] if last <= _GRID else brackets[key][1])
        seen = survey()
        lost = [k for k, r in ranks.items() if not seen[k][0] <= r <= sum(seen[k][:2]) - 1]
        if lost:
            raise RuntimeError(f"quantile brackets lost their rank: {lost}")

    # Equal values collapse here, so each target ranks at most its strictly-inside values plus two.
    cells = F.array(*[
        F.struct(F.lit(i).alias("_target"), F.when(inside(i), F.col(c)).alias("_v"))
        for i, (c, _) in enumerate(targets)])
    values = (
        bracketed().select("_group", F.inline(cells)).where(F.col("_v").isNotNull())
        .groupBy("_group", "_target", "_v").agg(F.count("*").alias("_n"))
    )
    upto = F.sum("_n").over(W.partitionBy("_group", "_target").orderBy("_v"))
    wanted = data.sparkSession.createDataFrame(
        [(g, targets.index((c, p)), c, float(p), math.floor(rank) - seen[g, c, p][0],
          math.ceil(rank) - seen[g, c, p][0], rank - math.floor(rank)) for (g, c, p), rank in ranks.items()],
        "_group int, _target int, column string, p double, _k0 long, _k1 long, _share double")
    ranked = values.withColumn("_upto", upto).join(F.broadcast(wanted), ["_group", "_target"])

    def at(rank: str) -> Column:
        reached = (F.col("_upto") > F.col(rank)) & (F.col("_upto") - F.col("_n") <= F.col(rank))
        return F.max(F.when(reached, F.col("_v")))

    values = ranked.groupBy("_group", "_target", "_share").agg(at("_k0").alias("_low"), at("_k1").alias("_high")).select(
        "_group", "_target", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("value"))
    every = data.sparkSession.createDataFrame(
        [(g, i, c, float(p)) for g in sizes for i, (c, p) in enumerate(targets)], "_group int, _target int, column string, p double")
    table = every.join(values, ["_group", "_target"], "left")
    if by:
        table = table.join(F.broadcast(groups), "_group").withColumnRenamed("_by", by)
    return table.select(*([by] if by else []), "column", "p", "value")

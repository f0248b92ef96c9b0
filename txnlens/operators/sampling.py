"""Exact, reproducible row selection without a global sort.

Rows are ordered by ``md5(seed-key)``. The n-th smallest digest of a class is found in two
steps: count rows per class and digest prefix (65,536 prefixes, combined map-side), then rank
only the rows of the one prefix that holds the cut. The selection itself is a plain filter
``digest <= cut``, so it needs no shuffle and both halves of a split come from one scan each.
Keys may repeat or be null: where a cut falls among rows of equal digest, these rows alone are
numbered and taken in part, so counts are exact for any key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.functions.checks import require_columns
from txnlens.functions.seeded import seeded_digest
from txnlens.operators.running import running_sums
from txnlens.session import materialize

_PREFIX = 4


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, _PREFIX)


def class_sizes(df: DataFrame, label: str) -> dict:
    """Rows per class; a handful of numbers."""
    require_columns(df, [label])
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


@dataclass(frozen=True)
class Cut:
    """Rows below ``digest`` are taken, and ``take`` of the ``of`` rows that have it."""

    digest: str
    take: int
    of: int


def digest_cuts(df: DataFrame, key: str, seed: int | str, wanted: dict, label: str | None = None) -> dict[object, Cut]:
    """Per class, where the ``wanted`` smallest digests end (no entry when none is wanted)."""
    require_columns(df, [key] + ([label] if label else []))
    cls = F.col(label) if label else F.lit(0)
    hashed = df.select(cls.alias("_class"), seeded_digest(seed, F.col(key)).alias("_digest"))
    need = F.lit(None).cast("long")
    for value, n in wanted.items():
        need = F.when(F.col("_class").eqNullSafe(F.lit(value)), F.lit(n)).otherwise(need)
    # At most 65,536 rows per class.
    counts = hashed.groupBy("_class", _prefix(F.col("_digest")).alias("_start")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(W.partitionBy("_class").orderBy("_start"))
    borders = (
        counts.withColumn("_upto", upto).withColumn("_need", need)
        .where((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
        .select("_class", "_start", (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_place")).collect()
    )
    if not borders:
        return {}
    on_border = F.lit(None).cast("long")
    for b in borders:
        here = F.col("_class").eqNullSafe(F.lit(b["_class"])) & (_prefix(F.col("_digest")) == b["_start"])
        on_border = F.when(here, F.lit(b["_place"])).otherwise(on_border)
    # Equal digests count together, so a frequent key is one row here.
    upto = F.sum("_n").over(W.partitionBy("_class").orderBy("_digest"))
    cuts = (
        hashed.withColumn("_place", on_border).where(F.col("_place").isNotNull())
        .groupBy("_class", "_digest").agg(F.count("*").alias("_n"), F.first("_place").alias("_place"))
        .withColumn("_upto", upto).where((F.col("_upto") >= F.col("_place")) & (F.col("_upto") - F.col("_n") < F.col("_place"))).collect()
    )
    return {r["_class"]: Cut(r["_digest"], r["_place"] - r["_upto"] + r["_n"], r["_n"]) for r in cuts}


def with_places(df: DataFrame, key: str, seed: int | str, cuts: Sequence[dict[object, Cut]], label: str | None = None) -> DataFrame:
    """``df`` with ``_place``: where a row stands among those of its class and digest, if a cut divides these.

    They stand in the order of a hash of the whole row; which of two equal rows comes first cannot matter.
    """
    divided = {(cls, cut.digest) for of in cuts for cls, cut in of.items() if cut.take < cut.of}
    if not divided:
        return df.withColumn("_place", F.lit(1).cast("long"))
    hashed = df.withColumns({"_class": F.col(label) if label else F.lit(0), "_digest": seeded_digest(seed, F.col(key))})
    here = F.lit(False)
    for cls, digest in divided:
        here = here | (F.col("_class").eqNullSafe(F.lit(cls)) & (F.col("_digest") == F.lit(digest)))
    border = materialize(hashed.where(here).select(
        "*", F.xxhash64(*[F.col(c) for c in df.columns]).alias("_hash"), F.monotonically_increasing_id().alias("_row")), "border")
    placed = running_sums(border.select("_class", "_digest", "_hash", "_row"), ["_class", "_digest"], ["_hash", "_row"],
                          {"_place": F.lit(1).cast("long")}, label="border-order").select("_row", "_place")
    rest = hashed.where(~here).select(*df.columns, F.lit(1).cast("long").alias("_place"))
    return rest.unionByName(border.join(placed, "_row").select(*df.columns, "_place"))


def is_selected(key: str, seed: int | str, cuts: dict[object, Cut], label: str | None = None) -> Column:
    """True for rows before their class's cut; reads ``_place`` of :func:`with_places`."""
    digest = seeded_digest(seed, F.col(key))
    chosen = F.lit(False)
    for value, cut in cuts.items():
        own_class = F.col(label).eqNullSafe(F.lit(value)) if label else F.lit(True)
        within = digest <= F.lit(cut.digest)
        if cut.take < cut.of:
            within = (digest < F.lit(cut.digest)) | ((digest == F.lit(cut.digest)) & (F.col("_place") <= cut.take))
        chosen = chosen | (own_class & within)
    return chosen


def seeded_sample(df: DataFrame, n: int, *, key: str, seed: int | str = 42) -> DataFrame:
    """``n`` rows without replacement, or all rows when there are fewer."""
    cuts = digest_cuts(df, key, seed, {0: n})
    if not cuts:
        return df if n > 0 else df.limit(0)
    return with_places(df, key, seed, [cuts]).where(is_selected(key, seed, cuts)).drop("_place")


def train_counts(sizes: dict, test_size: float) -> dict:
    """Train rows per class: exact total, largest remainders rounded up (ties: class order)."""
    total = sum(sizes.values())
    train_total = total - math.ceil(total * test_size)
    share = {c: n * train_total / total for c, n in sizes.items()}
    counts = {c: math.floor(s) for c, s in share.items()}
    order = sorted(sizes, key=lambda c: (counts[c] - share[c], c is None, c))
    for c in order[: train_total - sum(counts.values())]:
        counts[c] += 1
    return counts


def stratified_split(df: DataFrame, *, key: str, label: str = "class", test_size: float = 0.2,
                     seed: int | str = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete, with exact counts per class."""
    tagged = with_split(df, key=key, label=label, test_size=test_size, seed=seed)
    return (tagged.where(F.col("split") == "train").drop("split"),
            tagged.where(F.col("split") == "test").drop("split"))


def with_split(df: DataFrame, *, key: str, label: str = "class", test_size: float = 0.2,
               seed: int | str = 42) -> DataFrame:
    """The table with a ``split`` column: train or test."""
    wanted = train_counts(class_sizes(df, label), test_size)
    cuts = digest_cuts(df, key, seed, wanted, label)
    chosen = is_selected(key, seed, cuts, label)
    placed = with_places(df, key, seed, [cuts], label)
    return placed.withColumn("split", F.when(chosen, F.lit("train")).otherwise(F.lit("test"))).drop("_place")


def with_folds(df: DataFrame, *, key: str, folds: int, label: str = "class", seed: int | str = 42,
               fold_column: str = "fold") -> DataFrame:
    """Stratified fold numbers 0..folds-1, equal in size per class up to one row."""
    require_columns(df, [key, label])
    sizes = class_sizes(df, label)
    fold, all_cuts = F.lit(0), []
    for step in range(1, folds):
        cuts = digest_cuts(df, key, f"{seed}-fold", {c: n * step // folds for c, n in sizes.items()}, label)
        fold = fold + F.when(is_selected(key, f"{seed}-fold", cuts, label), 0).otherwise(1)
        all_cuts.append(cuts)
    return with_places(df, key, f"{seed}-fold", all_cuts, label).withColumn(fold_column, fold).drop("_place")


def undersample(df: DataFrame, *, key: str, label: str = "class", seed: int | str = 42) -> DataFrame:
    """Every class thinned to the size of the smallest one."""
    sizes = class_sizes(df, label)
    cuts = digest_cuts(df, key, seed, {c: min(sizes.values()) for c in sizes}, label)
    return with_places(df, key, seed, [cuts], label).where(is_selected(key, seed, cuts, label)).drop("_place")


def dense_index(df: DataFrame, *, key: str, seed: int | str, output_column: str = "row_index") -> DataFrame:
    """Number rows 0..n-1 in digest order, with one small window per digest prefix."""
    hashed = df.withColumn("_digest", seeded_digest(seed, F.col(key))).withColumn("_start", _prefix(F.col("_digest")))
    before = F.sum("n").over(W.orderBy("_start").rowsBetween(W.unboundedPreceding, -1))
    offsets = (
        df.select(_prefix(seeded_digest(seed, F.col(key))).alias("_start"))
        .groupBy("_start").agg(F.count("*").alias("n"))
        .select("_start", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    # offsets has at most 65,536 rows.
    within = F.row_number().over(W.partitionBy("_start").orderBy("_digest"))
    return (
        hashed.withColumn("_within", within).join(F.broadcast(offsets), "_start")
        .withColumn(output_column, F.col("_before") + F.col("_within") - 1)
        .drop("_digest", "_start", "_within", "_before")
    )


def class_weights(df: DataFrame, *, label: str = "class") -> dict:
    """Balanced weights: rows / (classes * rows of the class)."""
    sizes = class_sizes(df, label)
    total = sum(sizes.values())
    return {c: total / (len(sizes) * n) for c, n in sizes.items()}


def add_class_weight(df: DataFrame, *, label: str = "class", output_column: str = "weight") -> DataFrame:
    weight = F.lit(None).cast("double")
    for value, w in class_weights(df, label=label).items():
        weight = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(w)).otherwise(weight)
    return df.withColumn(output_column, weight)

"""Correlations of many columns from blocks of products.

Every task adds up, for all pairs at once, the products of centered values and of the masks of cells that are there, as
matrix products over whole batches. What leaves a task is one row per pair of columns, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.functions.checks import require_columns

SUMS = ("n", "si", "sj", "sii", "sjj", "sij")


def vector_correlations(df: DataFrame, vector: str) -> DataFrame:
    """(``i``, ``j``, ``r``): pairwise-complete Pearson correlations of all positions of an array column.

    Two passes: means of a position, which make the sums safe against cancellation, then the products. Null and NaN cells
    are missing; rows without an array are left out; a position without spread has NaN, a pair without common rows null.
    All arrays have the same length.
    """
    require_columns(df, [vector])
    values = df.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("v"))
    first = values.select(F.size("v").alias("k")).first()
    if first is None:
        return df.sparkSession.createDataFrame([], "i int, j int, r double")
    width = first["k"]

    def cells(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(width, np.int64), np.zeros(width)
        for batch in batches:
            x = cells(batch)
            n += (~np.isnan(x)).sum(axis=0)
            total += np.nansum(x, axis=0)
        yield pa.RecordBatch.from_pydict({"i": np.arange(width, dtype=np.int32), "n": n, "total": total})

    rows = values.mapInArrow(sums, "i int, n long, total double").groupBy("i").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("mean")).collect()
    means = np.zeros(width)
    for r in rows:
        means[r["i"]] = r["mean"] or 0.0
    upper = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss, p = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            x = cells(batch) - means
            there = ~np.isnan(x)
            x, mask = np.where(there, x, 0.0), there.astype(float)
            n += mask.T @ mask
            s += x.T @ mask  # [i, j]: values of i where j is there
            ss += (x * x).T @ mask
            p += x.T @ x
        i, j = upper
        yield pa.RecordBatch.from_pydict({
            "i": i.astype(np.int32), "j": j.astype(np.int32), "n": n[i, j], "si": s[i, j], "sj": s[j, i], "sii": ss[i, j], "sjj": ss[j, i], "sij": p[i, j]})

    added = values.mapInArrow(products, "i int, j int, " + ", ".join(f"{c} double" for c in SUMS)).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in SUMS])
    some = F.nullif("n", F.lit(0.0))
    of_i, of_j = F.col("sii") - F.col("si") * F.col("si") / some, F.col("sjj") - F.col("sj") * F.col("sj") / some
    spread = F.sqrt(F.greatest(of_i, F.lit(0.0))) * F.sqrt(F.greatest(of_j, F.lit(0.0)))
    together = F.col("sij") - F.col("si") * F.col("sj") / some
    r = F.when(F.col("n") > 0, F.when(spread > 0, together / F.nullif(spread, F.lit(0.0))).otherwise(F.lit(float("nan"))))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return added.select(r.alias("r"), F.inline(both)).select("i", "j", "r")

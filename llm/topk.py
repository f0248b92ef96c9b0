"""Exact top-k inner products in three phases with a uniform threshold.

Rows and queries are dealt to cells (a block of queries against a block of rows), and the dimensions of a cell to
``parts`` lists of local scores whose sum is the score. Phase 1: every cell takes the k best of each local list and
gathers their scores; a query's k-th best is a safe cutoff. Phase 2: the cutoff goes back to the cells; a row that can
still win must reach ``cutoff / parts`` in at least one list, and such entries are collected. Phase 3: their remaining
local scores are added exactly; entries that reach the cutoff compete for the k places.

Vectors become integers, ``floor(scale * x)``, so scores are exact and ties are real. A cell sends at most k rows per
query, however many tie. Memory per cell is fixed by the block sizes.

Edge cases: vectors that are null or hold a null or non-finite component, and rows without id, take no part; rows equal
in id and vector count once, other rows with a query's id are not its candidates; shorter vectors are padded with
zeros; scores must fit a long; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import materialize


def usable(vector: Column) -> Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, good)


def matrix(column: pa.ChunkedArray, scale: int, width: int) -> np.ndarray:
    """Integer vectors as doubles, padded to ``width``."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = np.floor(scale * lists.flatten().to_numpy().astype(float))
    return out


def lists_of(left: np.ndarray, right: np.ndarray, parts: int) -> np.ndarray:
    """Local scores [part, query, row]; doubles where they are exact, else 64-bit integers."""
    width = left.shape[1]
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, width)
    if bound >= 2.0**53:
        left, right = left.astype(np.int64), right.astype(np.int64)
    cuts = np.linspace(0, width, parts + 1).astype(int)
    return np.stack([left[:, a:b] @ right[:, a:b].T for a, b in zip(cuts, cuts[1:], strict=False)])


def lowest(kind: np.dtype) -> float:
    return np.iinfo(np.int64).min if kind.kind == "i" else -np.inf


def best_rows(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, scale: int = 64, parts: int = 2, key: str = "vec_id",
          vector: str = "embedding", query_block: int = 1024, row_block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best other rows of every query row."""
    rows = vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = materialize(rows.dropDuplicates(["id", "v"]).withColumn("row", F.xxhash64("id", "v")), "vectors")
    size = rows.agg(F.count("*"), F.count_if("q"), F.max(F.size("v"))).first()
    width = max(parts, size[2] or 0)
    n_rows, n_queries = max(1, -(-size[0] // row_block)), max(1, -(-size[1] // query_block))
    grid = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = rows.select(F.col("id").alias("other"), F.col("v").alias("w"), F.pmod("row", F.lit(n_rows)).cast("int").alias("rb2")).withColumn("qb2", grid(n_queries))
    queries = rows.where("q").select("id", "v", "row", F.pmod(F.hash("row"), F.lit(n_queries)).cast("int").alias("qb"))

    def local(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = lists_of(matrix(a["v"], scale, width), matrix(b["w"], scale, width), parts)
        mine, other = a["id"].to_numpy(), b["other"].to_numpy()
        return lists, other, mine[:, None] == other[None, :]

    def gather(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        if a.num_rows and b.num_rows:
            lists, _, own = local(a, b)
            total = lists.sum(axis=0)
            floor = lowest(lists.dtype)
            n = min(k, lists.shape[2])
            for at in range(a.num_rows):
                picked = np.zeros(lists.shape[2], bool)
                for values in lists[:, at]:
                    values = np.where(own[at], floor, values)
                    picked[np.argpartition(-values, n - 1)[:n] if floor == -np.inf else np.argsort(values)[-n:]] = True
                picked &= ~own[at]
                top = np.sort(total[at][picked])[-k:]
                out.append((np.full(len(top), at), top.astype(np.int64)))
        at = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
        score = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.int64)
        return pa.table({"row": a["row"].to_numpy()[at] if len(at) else np.zeros(0, np.int64), "score": score})

    def collect(a: pa.Table, b: pa.Table) -> pa.Table:
        got: dict[str, list[np.ndarray]] = {"row": [], "query_id": [], "vec_id": [], "score": []}
        if a.num_rows and b.num_rows:
            lists, other, own = local(a, b)
            cut = np.asarray([float("-inf") if x is None else x for x in a["cutoff"].to_pylist()])
            row, mine = a["row"].to_numpy(), a["id"].to_numpy()
            for at in range(a.num_rows):
                near = np.flatnonzero((lists[:, at] >= cut[at] / parts).any(axis=0) & ~own[at])
                score = lists[:, at, near].sum(axis=0)  # the remaining local scores
                near, score = near[score >= cut[at]], score[score >= cut[at]].astype(np.int64)
                best = best_rows(score, other[near], k)
                for name, values in zip(got, (np.full(len(best), row[at]), np.full(len(best), mine[at]), other[near[best]], score[best]),
                                        strict=True):
                    got[name].append(values)
        return pa.table({n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in got.items()})

    cells = lambda q: q.withColumn("rb", grid(n_rows)).groupBy("qb", "rb").cogroup(right.groupBy("qb2", "rb2"))
    gathered = cells(queries).applyInArrow(gather, "row long, score long")
    nth = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score")))
    cutoffs = materialize(gathered.withColumn("n", nth).where(F.col("n") == k).select("row", F.col("score").alias("cutoff")), "cutoffs")
    found = cells(queries.join(cutoffs, "row", "left")).applyInArrow(collect, "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Search of a stated query set against all vectors, in blocks.

Vectors are dealt into blocks of about ``BLOCK_ROWS`` rows by a hash of their id, queries likewise; a task handles one
(vector block, query block) pair, so its memory is bounded whatever the size of the tables and hot vectors spread
evenly. Each task returns, per query, its block's best as one packed row; the best over all blocks are ranked by a window
whose group limit Spark applies before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
QUERY_ROWS = 2048


def usable(df: DataFrame, id_col: str, vec_col: str, nonzero: bool) -> DataFrame:
    """(vec_id, x, dim) of the vectors that take part: not null or empty, all components finite, id not null."""
    x = F.col("x")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    out = (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<float>").alias("x"))
           .where(F.col("vec_id").isNotNull() & x.isNotNull()).where((F.size(x) > 0) & fine))
    if nonzero:
        out = out.where(F.exists(x, lambda v: v != 0))
    return out.withColumn("dim", F.size("x"))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(flat).reshape(-1, dim) if flat else np.empty((0, dim), np.float32)


def distinct_rows(x: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different vectors, and for each its ``keep`` smallest ids: no more of them can be among a query's nearest."""
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    _, first, inverse = np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1] * x.itemsize}").ravel(),
                                  return_index=True, return_inverse=True)
    by = np.argsort(inverse, kind="stable")
    groups = np.split(ids[by], np.cumsum(np.bincount(inverse))[:-1])
    return x[first], [np.unique(g)[:keep] for g in groups]


def best(scores: np.ndarray, rows: np.ndarray, groups: list[np.ndarray], own: int, k: int) -> tuple[list, list]:
    """The k best (score, id) among the distinct vectors ``rows`` without the query itself; ties to the smaller id."""
    if len(rows) > k + 1:
        edge = np.partition(scores, len(rows) - k - 1)[len(rows) - k - 1]  # the query's own class may take one place
        at = scores >= edge
        scores, rows = scores[at], rows[at]
    ids = np.concatenate([groups[r] for r in rows]) if len(rows) else np.empty(0, np.int64)
    full = np.repeat(scores, [len(groups[r]) for r in rows])
    other = ids != own
    ids, full = ids[other], full[other]
    order = np.lexsort((ids, -full))[:k]
    return full[order].tolist(), ids[order].tolist()


def search(vectors: DataFrame, is_query: Column, k: int, score_type: str,
           solve: Callable[[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, int], list[tuple[list, list]]],
           block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best.

    ``vectors`` has columns vec_id, x, dim; only vectors of one length are compared. ``solve`` gets the block's different
    vectors, their ids, the queries, their ids and k, and returns (scores, ids) per query.
    """
    # ids, not rows, are counted: a scan of one narrow column
    total, asked = vectors.agg(F.count("*"), F.count_if(is_query)).head()
    nb, nq = max(1, -(-total // block_rows)), max(1, -(-asked // query_rows))
    of = F.xxhash64("vec_id")
    queries = (vectors.where(is_query).withColumn("j", F.pmod(of, F.lit(nq)).cast("int"))
               .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))))
    rows = (vectors.withColumn("i", F.pmod(of, F.lit(nb)).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dim, out = key[0].as_py(), {"query_id": [], "vec_ids": [], "scores": []}
        if left.num_rows and right.num_rows:
            x, groups = distinct_rows(matrix(left.column("x"), dim), left.column("vec_id").to_numpy(), k + 1)
            ids = right.column("vec_id").to_numpy()
            for own, (scores, near) in zip(ids.tolist(), solve(x, groups, matrix(right.column("x"), dim), ids, k), strict=True):
                out["query_id"].append(own)
                out["vec_ids"].append(near)
                out["scores"].append(scores)
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_ids", pa.list_(pa.int64())),
                                               ("scores", pa.list_(pa.float64() if score_type == "double" else pa.int64()))]))

    found = (rows.groupBy("dim", "i", "j").cogroup(queries.groupBy("dim", "i", "j"))
             .applyInArrow(run, f"query_id long, vec_ids array<long>, scores array<{score_type}>"))
    flat = (found.select("query_id", F.explode(F.arrays_zip("vec_ids", "scores")).alias("n"))
            .select("query_id", F.col("n.vec_ids").alias("vec_id"), F.col("n.scores").alias("score")).distinct())
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return flat.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

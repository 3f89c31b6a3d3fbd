"""Exact top-k inner products by multi-resolution segment statistics (operator 7).

Vectors are integers floor(scale * component). A vector is cut into 1, 2, 4, ... segments; of each segment its mean m, its
deviation s (root of the mean square deviation) and its length L are kept. For a vector x and a query q the sum of
L * (mx * mq + sx * sq) over the segments is an upper bound of their inner product (Cauchy-Schwarz on the deviations), that is
a lower bound of the distance |x|^2 + |q|^2 - 2 x.q with both norms known. From coarse to fine, candidates whose bound is below
the k-th best exact score known so far are dropped; the survivors get exact scores. A bound carries a relative slack for
rounding, so no true neighbour is dropped. The first threshold comes from exact scores of the best bounds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from .blocks import BLOCK_ROWS, QUERY_ROWS, best, search, usable

SCALE = 64
LEVELS = (1, 2, 4, 8, 16)
AT_ONCE = 128  # queries bounded at a time: memory of a task


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Columns whose inner products are the bounds: root-length weighted means, then deviations."""
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(int)
    parts = [x[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
    weight = np.sqrt([p.shape[1] for p in parts])
    mean = np.stack([p.mean(axis=1) for p in parts], axis=1)
    dev = np.stack([p.std(axis=1) for p in parts], axis=1)
    return np.hstack([mean * weight, dev * weight])


def solve(x: np.ndarray, groups: list[np.ndarray], queries: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[list, list]]:
    """Exact while |score| < 2^53."""
    x = np.floor(x.astype(np.float64) * SCALE)
    queries = np.floor(queries.astype(np.float64) * SCALE)
    levels = [(statistics(x, s), statistics(queries, s)) for s in LEVELS if s <= x.shape[1]]
    slack = 1e-9 * (1 + np.sqrt((x ** 2).sum(axis=1).max()) * np.sqrt((queries ** 2).sum(axis=1)))
    n, take = len(x), min(k + 1, len(x))  # one place more: the query itself is among the vectors
    out = []
    for at in range(0, len(queries), AT_ONCE):
        q, some = queries[at:at + AT_ONCE], slack[at:at + AT_ONCE]
        bound = levels[-1][1][at:at + AT_ONCE] @ levels[-1][0].T
        seeds = np.argpartition(bound, n - take, axis=1)[:, n - take:]
        floor = np.array([(x[s] @ v).min() for s, v in zip(seeds, q, strict=True)]) - some
        del bound
        rows = cols = None
        for stat_x, stat_q in levels:
            if rows is None:
                rows, cols = np.nonzero(stat_q[at:at + AT_ONCE] @ stat_x.T >= floor[:, None])
            elif len(rows) * 4 > len(q) * n:  # still dense: one product for all, then the survivors' bounds
                dense = stat_q[at:at + AT_ONCE] @ stat_x.T
                stay = dense[rows, cols] >= floor[rows]
                rows, cols = rows[stay], cols[stay]
            else:
                stay = np.einsum("ij,ij->i", stat_q[at:at + AT_ONCE][rows], stat_x[cols]) >= floor[rows]
                rows, cols = rows[stay], cols[stay]
        ends = np.searchsorted(rows, np.arange(len(q) + 1))
        for r, own in enumerate(ids[at:at + AT_ONCE].tolist()):
            left = cols[ends[r]:ends[r + 1]]
            scores, near = best(x[left] @ q[r], left, groups, own, k)
            out.append(([int(s) for s in scores], near))
    return out


def top(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
        block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, ties to the smaller id.

    ``is_query`` is a condition on column ``vec_id``. Null, empty or non-finite vectors and null ids take no part (zero
    vectors do); an empty table gives an empty result; vectors of another length than the query's are not its candidates;
    rows that repeat an id and a vector count once; other columns are ignored.
    """
    return search(usable(df, id_col, vec_col, nonzero=False), is_query, k, "long", solve, block_rows, query_rows)

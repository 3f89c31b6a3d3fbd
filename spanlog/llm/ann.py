"""Approximate nearest neighbours by collision counting (operator 3).

Every block of vectors is projected on ``projections`` random lines and each projection is kept as one sorted array. A query
opens on every line a window centred on its own projection, found by binary search; a vector whose place in the array lies
in the window collides on that line. Windows widen by ``growth`` per level (virtual rehashing: the arrays stay, only the ends
move). Vectors whose collisions reach ``threshold`` * projections become candidates. The first level with ``k`` + ``verify`` *
rows candidates counts; all of them are then verified by the exact inner product.

Largest inner product is turned into nearest distance by one added component, sqrt(M^2 - |x|^2), M being the block's largest
norm; queries are scaled to norm M. Every vector is indexed; recall is measured in the tests and the README.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame

from .blocks import BLOCK_ROWS, QUERY_ROWS, best, search, usable

PROJECTIONS = 64
THRESHOLD = 0.6
GROWTH = 1.15
FIRST_WIDTH = 0.5
VERIFY = 0.35
SEED = 20


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added in one order whatever the number of rows: equal vectors tie exactly."""
    return (x.astype(np.float64) * q.astype(np.float64)).sum(axis=1)


def solve(x: np.ndarray, groups: list[np.ndarray], queries: np.ndarray, ids: np.ndarray, k: int, *, projections: int,
          threshold: float, growth: float, first_width: float, verify: float, seed: int) -> list[tuple[list, list]]:
    n, dim = x.shape
    # scaling by the largest component first: norms of any finite float32 stay finite in double precision
    unit = x / np.abs(x).max().astype(np.float64)
    norm2 = (unit ** 2).sum(axis=1)
    most = norm2.max()
    lines = np.random.default_rng(seed).standard_normal((dim + 1, projections))
    at = np.hstack([unit, np.sqrt(np.maximum(most - norm2, 0))[:, None]]) @ lines
    place = np.uint16 if n < 1 << 16 else np.uint32
    values = np.sort(at, axis=0).T.copy()  # one sorted array per line
    ranks = np.empty((projections, n), place)  # every vector's place in them
    np.put_along_axis(ranks, np.argsort(at, axis=0, kind="stable").T, np.arange(n, dtype=place)[None, :], axis=1)
    width = np.sqrt(most)
    need, enough = max(1, int(np.ceil(threshold * projections))), min(n, k + 1 + int(verify * n))
    widths = [first_width * width]
    while widths[-1] < 16 * width:
        widths.append(widths[-1] * growth)
    q = queries / np.abs(queries).max(axis=1, keepdims=True).astype(np.float64)
    centre = np.sqrt(most) / np.sqrt((q ** 2).sum(axis=1))[:, None] * (q @ lines[:dim])

    def ends(w: float) -> tuple[np.ndarray, np.ndarray]:
        """Window ends, as places in the sorted arrays, of every query and line."""
        low = [np.searchsorted(v, c - w, "left") for v, c in zip(values, centre.T, strict=True)]
        high = [np.searchsorted(v, c + w, "right") for v, c in zip(values, centre.T, strict=True)]
        return np.array(low).T.astype(place), (np.array(high) - np.array(low)).T.astype(place)

    windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    counter = np.uint8 if projections < 256 else np.uint16

    def candidates(i: int, level: int) -> np.ndarray:
        if level not in windows:
            windows[level] = ends(widths[level])
        low, span = windows[level]
        inside = ranks - low[i][:, None] < span[i][:, None]  # unsigned: places before the window wrap to large ones
        return inside.view(np.uint8).sum(axis=0, dtype=counter) >= need

    double, out, level = x.astype(np.float64), [], 0
    for i, own in enumerate(ids.tolist()):
        # counts grow with the window, so the first level with enough candidates is found from the last query's
        found = candidates(i, level)
        if np.count_nonzero(found) >= enough:
            while level and np.count_nonzero(less := candidates(i, level - 1)) >= enough:
                level, found = level - 1, less
        else:
            while level + 1 < len(widths) and np.count_nonzero(found) < enough:
                level += 1
                found = candidates(i, level)
        rows = np.nonzero(found)[0]
        if len(rows) <= k:
            rows = np.arange(n)  # the widest windows left fewer than k + 1: verify the whole block
        near = double[rows] @ queries[i].astype(np.float64)
        if len(rows) > k + 1:  # only those that rounding may still place among the best are added up anew
            edge = np.partition(near, len(rows) - k - 1)[len(rows) - k - 1]
            rows = rows[near >= edge - 1e-9 * (1 + np.abs(near).max())]
        out.append(best(exact(x[rows], queries[i]), rows, groups, own, k))
    return out


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            projections: int = PROJECTIONS, threshold: float = THRESHOLD, growth: float = GROWTH,
            first_width: float = FIRST_WIDTH, verify: float = VERIFY, seed: int = SEED,
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, by largest inner product, ties to the smaller id.

    ``is_query`` is a condition on column ``vec_id``. Null, zero, empty or non-finite vectors and null ids take no part;
    an empty table gives an empty result; vectors of another length than the query's are not its candidates; rows that
    repeat an id and a vector count once; other columns are ignored.
    """
    parameters = {"projections": projections, "threshold": threshold, "growth": growth, "first_width": first_width,
                  "verify": verify, "seed": seed}
    return search(usable(df, id_col, vec_col, nonzero=True), is_query, k, "double", partial(solve, **parameters),
                  block_rows, query_rows)

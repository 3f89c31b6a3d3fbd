"""Hard-negative mining over anchor-clustered shared lists (operator 13).

Anchors are clustered by angle. Inside a task one cluster meets one block of rows: the block is sorted once by the angular bound
|x| cos(max(0, angle(x, centre) - widest angle(member, centre))), which no member's inner product divided by the member's norm can
exceed, and every member walks that one list. A member stops when the bound shows that no row further on can reach its wanted
rank: a certified end, so results are exact whatever the clusters. Centres come from a bounded sample of anchors
(``SAMPLE``); they decide how early walks end and nothing else.

Rows lie in blocks of about ``BLOCK_ROWS`` of one angular cell (a cell is cut by a hash of the id, so a vector that a third of the
rows repeat spreads over blocks), anchors in batches of about ``BATCH_ROWS`` of neighbouring cells. Three walks follow. The first
meets anchors with the blocks of their own cell and gives each a score that its last positive reaches at least. The second meets
batches with the other cells, those left out whose angle proves that none of their rows can reach any such score. The third finds
negatives the same way, from the lowest score that a positive admits. Only cells' sizes and angles reach the driver (``CENTRES``
rows at most).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .integers import integer_vectors, matrix

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # a negative's score lies between these hundredths of its positive's; fixed by the contract
BLOCK_ROWS = 8192
BATCH_ROWS = 4096
CENTRES = 256
MEMBERS = 64  # anchors a cluster should have at least
SAMPLE = 4096  # anchors that centres are fitted on
FIRST_STEP, MOST_STEP = 256, 2048
NEED_ROWS = 1024  # walks side by side: bounds a task's memory
SLACK = 1e-9


@dataclass
class Needs:
    """What walks look for: ``k`` best rows of the same (or another) label with ``low`` <= score <= ``high``, not of id ``own``."""
    q: np.ndarray
    own: np.ndarray
    label: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def angles(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit(x) @ centre, -1, 1))


def first_k(need: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each need's k best, by falling score, ties to the smaller id."""
    order = np.lexsort((ids, -score, need))
    of = need[order]
    start = np.concatenate([[0], np.nonzero(of[1:] != of[:-1])[0] + 1]) if len(of) else np.empty(0, int)
    rank = np.arange(len(of)) - np.repeat(start, np.diff(np.append(start, len(of))))
    return order[rank < k]


def walk(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, centre: np.ndarray, needs: Needs) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(need, score, id) of the best rows found and the number of scores computed. All members' needs share one list."""
    norm = np.sqrt((x * x).sum(axis=1))
    q_norm = np.sqrt((needs.q * needs.q).sum(axis=1))
    widest = angles(needs.q, centre)[q_norm > 0].max(initial=0.0)
    bound = norm * np.cos(np.maximum(0, np.where(norm > 0, angles(x, centre), np.pi / 2) - widest))
    order = np.argsort(-bound, kind="stable")
    bound = bound[order]
    reach = needs.low.astype(float)  # what a row must score at least to matter
    live = np.arange(len(reach))
    need, score, near = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
    at, step, work = 0, FIRST_STEP, 0
    while at < len(order):
        best = q_norm[live] * bound[at]
        live = live[best + SLACK * (1 + np.abs(best)) >= reach[live]]
        if not len(live):
            break
        rows = order[at:at + step]
        found = needs.q[live] @ x[rows].T
        work += found.size
        ok = (found >= reach[live][:, None]) & (found <= needs.high[live][:, None]) & (ids[rows][None, :] != needs.own[live][:, None])
        ok &= (labels[rows][None, :] == needs.label[live][:, None]) == needs.same
        r, c = np.nonzero(ok)
        need, score, near = np.concatenate([need, live[r]]), np.concatenate([score, found[r, c]]), np.concatenate([near, ids[rows][c]])
        stay = first_k(need, score, near, needs.k)
        need, score, near = need[stay], score[stay], near[stay]
        last = np.nonzero(np.bincount(need, minlength=len(reach))[need] == needs.k)[0][needs.k - 1::needs.k]
        reach[need[last]] = score[last]
        at, step = at + step, min(step * 2, MOST_STEP)
    return need, score, near, work


def fit_centres(anchors: DataFrame, n_anchors: int, dim: int, centres: int = CENTRES, members: int = MEMBERS, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors: spherical means of at most ``sample`` anchors, those with the smallest hashes of their ids."""
    rows = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").select("x").limit(sample).collect()
    x = unit(np.array([r["x"] for r in rows], float).reshape(-1, dim))
    x = np.unique(x, axis=0)
    k = max(1, min(centres, n_anchors // members, len(x)))
    chosen, far = [0], x @ x[0]
    while len(chosen) < k:  # each next start is the anchor farthest from those before it
        chosen.append(int(far.argmin()))
        far = np.maximum(far, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(8):
        of = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        c = np.where((np.abs(total).sum(axis=1) > 0)[:, None], unit(total), c)
    return c


def with_cells(rows: DataFrame, centres: np.ndarray, dim: int) -> DataFrame:
    """Adds ``cell`` (the nearest centre) and ``angle`` to it."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = unit(matrix(batch.column("x"), dim).astype(float)) @ centres.T
            cell = u.argmax(axis=1) if len(u) else np.empty(0, np.int64)
            angle = np.arccos(np.clip(u[np.arange(len(u)), cell], -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(angle)], [*names, "cell", "angle"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, cell int, angle double")


def dealt(sizes: dict[int, int], rows: int) -> tuple[dict[int, int], dict[int, int], int]:
    """(first number, numbers) of every cell and their total: small cells in turn share a number, a large one takes several."""
    first: dict[int, int] = {}
    count: dict[int, int] = {}
    number, used = 0, 0
    for cell in sorted(sizes):
        if used and used + sizes[cell] > rows:
            number, used = number + 1, 0
        first[cell], count[cell] = number, max(1, -(-sizes[cell] // rows))
        if count[cell] > 1:
            number, used = number + count[cell], 0
        else:
            used += sizes[cell]
    return first, count, number + 1


def lookup(values: dict[int, int], key: Column) -> Column:
    """``values[key]``; keys are cell numbers."""
    return F.get(F.array(*[F.lit(values.get(i, 0)) for i in range(max(values, default=0) + 1)]), key)


class Search:
    """Anchors and rows of one vector length, dealt into batches and blocks."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, dim: int, n_anchors: int, block_rows: int, batch_rows: int, centres: int, members: int):
        self.dim, self.centres = dim, fit_centres(anchors, n_anchors, dim, centres, members)
        self.rows = stored(with_cells(rows, self.centres, dim), "negatives-rows")
        is_anchor = F.col("is_anchor")
        norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v))
        self.cells = {r["cell"]: r for r in self.rows.groupBy("cell").agg(
            F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max("angle").alias("angle"),
            F.max(F.when(is_anchor, F.col("angle"))).alias("widest"), F.max(norm).alias("norm")).collect()}
        first, count, _ = dealt({c: r["n"] for c, r in self.cells.items()}, block_rows)
        hashed = F.xxhash64("vec_id")
        self.block = lookup(first, F.col("cell")) + F.pmod(hashed, lookup(count, F.col("cell"))).cast("int")
        self.blocks_of = {c: range(first[c], first[c] + count[c]) for c in first}
        first, count, _ = dealt({c: r["anchors"] for c, r in self.cells.items() if r["anchors"]}, batch_rows)
        self.batch = lookup(first, F.col("cell")) + F.pmod(hashed, lookup(count, F.col("cell"))).cast("int")
        self.batches_of = {c: range(first[c], first[c] + count[c]) for c in first}

    def pairs(self, reach: dict[int, float]) -> dict[int, list[int]]:
        """Anchors' cells by cell of rows that may hold wanted ones. ``reach`` is per anchors' cell the least of (wanted score / norm);
        a cell of rows is out if its norm and angle prove that it stays below."""
        apart = np.arccos(np.clip(self.centres @ self.centres.T, -1, 1))
        out: dict[int, list[int]] = {}
        for a, low in reach.items():
            for b in self.cells:
                bound = self.cells[b]["norm"] * np.cos(max(0.0, apart[a, b] - self.cells[a]["widest"] - self.cells[b]["angle"]))
                if bound + SLACK * (1 + abs(bound)) >= low:
                    out.setdefault(b, []).append(a)
        return out

    def run(self, wanted: DataFrame, pairs: dict[int, list[int]], same: bool, k: int) -> DataFrame:
        """(vec_id, want, near, score): the best of every need within every pair of a block and a batch.

        ``wanted`` has vec_id, cell, x, label, want (a number per anchor), low and high. Rows and anchors that share a block or
        a batch with a pair of cells meet as well."""
        back: dict[int, list[int]] = {}
        for b, of in pairs.items():
            for a in of:
                back.setdefault(a, []).append(b)

        def numbers(of: dict[int, list[int]], spans: dict[int, range]) -> Column:
            """The batches (blocks) of the cells that meet a row's cell. The text lists pairs of cells, ``CENTRES`` squared at most."""
            cells = [[c for c in of.get(n, []) if c in spans] for n in range(max(of, default=0) + 1)]
            listed = F.expr(f"array({','.join('cast(array(' + ','.join(map(str, c)) + ') as array<int>)' for c in cells)})")
            spread = F.transform(F.coalesce(F.get(listed, F.col("cell")), F.array().cast("array<int>")), lambda c: F.sequence(
                lookup({k: s.start for k, s in spans.items()}, c), lookup({k: s.stop - 1 for k, s in spans.items()}, c)))
            return F.explode(F.array_distinct(F.flatten(spread)))

        left = (self.rows.withColumn("i", self.block).withColumn("j", numbers(pairs, self.batches_of)).select("i", "j", "vec_id", "label", "x"))
        right = (wanted.withColumn("j", self.batch).withColumn("i", numbers(back, self.blocks_of))
                 .select("i", "j", "cell", "vec_id", "want", "label", "low", "high", "x"))
        dim, centres = self.dim, self.centres

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            out = [[], [], [], []]
            if a.num_rows and b.num_rows:
                x, ids, labels = matrix(a.column("x"), dim).astype(float), a.column("vec_id").to_numpy(), a.column("label").to_numpy()
                q, cell = matrix(b.column("x"), dim).astype(float), b.column("cell").to_numpy()
                own, want, label = (b.column(c).to_numpy() for c in ("vec_id", "want", "label"))
                low, high = (b.column(c).to_numpy() for c in ("low", "high"))
                for c in np.unique(cell):
                    members = np.nonzero(cell == c)[0]
                    for at in range(0, len(members), NEED_ROWS):
                        m = members[at:at + NEED_ROWS]
                        need, score, near, _ = walk(x, ids, labels, centres[c], Needs(q[m], own[m], label[m], low[m], high[m], same, k))
                        for column, values in zip(out, (own[m][need], want[m][need], near, score.astype(np.int64)), strict=True):
                            column.append(values)
            arrays = [pa.array(np.concatenate(o) if o else np.empty(0, np.int64), t) for o, t in
                      zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)]
            return pa.Table.from_arrays(arrays, ["vec_id", "want", "near", "score"])

        return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(run, "vec_id long, want int, near long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of every (vec_id, want) with their rank."""
    rank = F.row_number().over(Window.partitionBy("vec_id", "want").orderBy(F.desc("score"), "near"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _reach(wanted: DataFrame) -> dict[int, float]:
    """Per cell the least score, relative to the anchor's norm, that any of its needs asks for."""
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v))
    ratio = F.when(norm > 0, F.col("low") / norm).otherwise(F.lit(float("-inf")))
    return {r["cell"]: r["reach"] for r in wanted.groupBy("cell").agg(F.min(ratio).alias("reach")).collect()}


def mine(df: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS,
         batch_rows: int = BATCH_ROWS, centres: int = CENTRES, members: int = MEMBERS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``label`` is an integer expression over ``df``, ``is_anchor`` a condition on column ``vec_id``. An anchor's positives are its
    ``positives`` best other rows of the same label by integer inner product, ties to the smaller id; a positive's negatives are the
    first ``negatives`` rows of another label whose score lies between ``low`` and ``high`` hundredths of the positive's. Rows with
    a null id, label or vector, an empty or non-finite vector or a component beyond ``integers.limit`` take no part (zero vectors
    do). Of rows that share an id the one with the smallest (label, vector) stands for it; only vectors of one length meet. An empty
    table, no anchor or no fitting negative gives an empty result; other columns are ignored.
    """
    src = df.select("*", label.cast("long").alias("_label")).where("_label IS NOT NULL")
    every = integer_vectors(src, scale, ("_label",), id_col, vec_col)
    every = every.groupBy("vec_id").agg(F.min(F.struct(F.col("_label").alias("label"), "x", "dim")).alias("r")).select("vec_id", "r.label", "r.x", "r.dim")
    every = stored(every.withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))), "negatives-integers")
    out = None
    for r in every.where("is_anchor").groupBy("dim").count().orderBy("dim").collect():  # usually one length
        part = every.where(F.col("dim") == r["dim"]).drop("dim")
        s = Search(part, part.where("is_anchor"), r["dim"], r["count"], block_rows, batch_rows, centres, members)
        pick = ("vec_id", "cell", "x", "label")
        anchors = s.rows.where("is_anchor").select(*pick)
        start = anchors.select(*pick, F.lit(0).alias("want"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"))
        near = stored(best(s.run(start, {c: [c] for c in s.batches_of}, True, positives), positives), "negatives-home")
        floor = near.where(F.col("rank") == positives).select(F.col("vec_id").alias("_id"), F.col("score").alias("_low"))
        raised = stored(start.join(floor, F.col("vec_id") == F.col("_id"), "left")
                        .withColumn("low", F.coalesce(F.col("_low").cast("double"), "low")).drop("_id", "_low"), "negatives-raised")
        away = {b: [a for a in of if a != b] for b, of in s.pairs(_reach(raised)).items()}
        more = s.run(raised, away, True, positives)  # some neighbours of home cells are met again
        found = stored(best(near.drop("rank").unionByName(more).distinct(), positives)
                       .select(F.col("vec_id").alias("anchor_id"), F.col("rank").alias("want"), F.col("near").alias("positive_id"), F.col("score").alias("positive_score")),
                       "negatives-positives")
        # integers a, b with low * p <= 100 * n <= high * p: n from ceil(low * p / 100) to floor(high * p / 100)
        def floored(percent: Column) -> Column:
            return ((percent - F.pmod(percent, F.lit(100))) / 100).cast("double")  # exact: the quotient is whole
        p = F.col("positive_score").cast("decimal(25,0)")
        asked = (anchors.join(found, F.col("vec_id") == F.col("anchor_id"))
                 .select(*pick, "want", (-floored(-p * low)).alias("low"), floored(p * high).alias("high")).where("low <= high"))
        asked = stored(asked, "negatives-asked")
        got = best(s.run(asked, s.pairs(_reach(asked)), False, negatives), negatives)
        got = (got.withColumnRenamed("vec_id", "anchor_id").join(found, ["anchor_id", "want"])
               .select("anchor_id", "positive_id", "rank", F.col("near").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
        out = got if out is None else out.unionByName(got)
    if out is None:
        return every.limit(0).select(F.col("vec_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.lit(0).alias("rank"),
                                     F.col("vec_id").alias("negative_id"), F.col("vec_id").alias("positive_score"), F.col("vec_id").alias("negative_score"))
    return out


ORACLE = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id AND len(a.x) = len(v.x)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= {POSITIVES}),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""

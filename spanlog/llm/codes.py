"""Vector code compression with memoised grid cells (operator 11).

A vector of integers is cut into ``parts`` equal consecutive parts, and every part position has a codebook of up to ``entries``
entries, trained by ``rounds`` of assignment and integer means. All arithmetic is exact.

Assignment: a part lies in a coarse grid cell of ``cell`` units a side. The first part met in a cell (cells are found by a hash of
their coordinates, which are compared) decides which entries can be nearest to any point of the cell's box: an entry is dominated
if its smallest distance to the box exceeds another's largest, or if another is nearer at every corner of the box (the difference
of two squared distances is linear, so its extremes over the box are exact). The entries left are kept for the cell, and every
part in it is compared with those alone. The memory lives as long as a task's codebook, up to ``CELLS`` cells a part position; when
it is full it starts anew, which changes no result.

Spark's part: a round is one pass over the stored integers; tasks return sums and counts per entry (at most parts x entries rows
each), which Spark adds up. Only the codebooks, bounded by the same number, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .integers import integer_vectors, matrix

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELL = 512
CELLS = 1 << 16
ROWS_AT_ONCE = 4096


def not_dominated(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Boxes x entries: whether an entry may be nearest (ties included) to an integer point of the box [low, high]."""
    nearest = np.zeros((len(low), len(entries)), np.int64)
    farthest = np.zeros_like(nearest)
    for i in range(entries.shape[1]):
        below, above = low[:, i:i + 1] - entries[:, i], entries[:, i] - high[:, i:i + 1]
        nearest += np.maximum(np.maximum(below, above), 0) ** 2
        farthest += np.maximum(-below, -above) ** 2  # to the end of the box that lies further off
    stays = nearest <= farthest.min(axis=1, keepdims=True)
    # least over the box of |x - a|^2 - |x - b|^2 = |a|^2 - |b|^2 - 2 x (a - b): at the middle less half the box's width per component
    gap = (entries[:, None] - entries[None]).astype(float)
    norm = (entries.astype(float) ** 2).sum(axis=1)
    middle, half = (low + high) / 2.0, (high - low)[:1] / 2.0
    flat = gap.reshape(-1, entries.shape[1])
    least = (norm[:, None] - norm[None]).ravel() - 2 * (middle @ flat.T) - 2 * (np.abs(flat) * half).sum(axis=1)
    slack = 1e-9 * (1 + np.abs(middle).max(initial=0.0) * np.abs(flat).sum(axis=1).max(initial=0.0) + norm.max(initial=0.0))  # keeps more, never less
    return stays & (least <= slack).reshape(len(low), len(entries), len(entries)).all(axis=2)


class Assigner:
    """Nearest entries of one part position; ``evaluated`` counts exact distances, ``cells`` the boxes decided."""

    def __init__(self, entries: np.ndarray, cell: int = CELL, cells: int = CELLS):
        self.entries, self.cell, self.most = entries, cell, cells
        self.mix = np.random.default_rng(11).integers(1, 1 << 62, entries.shape[1]).astype(np.uint64) | np.uint64(1)
        self.evaluated = self.cells = 0
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.places, self.stays = np.empty(0, np.uint64), np.empty((0, self.entries.shape[1]), np.int64), np.empty((0, len(self.entries)), bool)

    def _candidates(self, x: np.ndarray) -> np.ndarray:
        """Rows x entries that the rows' cells have kept."""
        place = np.floor_divide(x, self.cell)
        code = (place.astype(np.uint64) * self.mix).sum(axis=1, dtype=np.uint64)
        distinct, first, of = np.unique(code, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        if not known.all():
            if len(self.hashes) + np.count_nonzero(~known) > self.most:
                self._forget()
                known[:] = False
            new = place[first[~known]]
            stays = not_dominated(new * self.cell, new * self.cell + self.cell - 1, self.entries)
            self.cells += len(new)
            hashes = np.concatenate([self.hashes, distinct[~known]])
            order = np.argsort(hashes)
            self.hashes, self.places = hashes[order], np.concatenate([self.places, new])[order]
            self.stays = np.concatenate([self.stays, stays])[order]
            at = np.searchsorted(self.hashes, distinct)
        same = (self.places[at][of] == place).all(axis=1)
        return self.stays[at][of] | ~same[:, None]  # a cell that shares another's hash keeps every entry

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of every row's nearest entry; ties to the lower index."""
        if not len(x):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        rows, entry = np.nonzero(self._candidates(x))  # every row keeps at least one
        self.evaluated += len(rows)
        distance = ((x[rows] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(rows, np.arange(len(x)))
        least = np.minimum.reduceat(distance, starts)
        index = np.minimum.reduceat(np.where(distance == least[rows], entry, len(self.entries)), starts)
        return index, least


def cuts(dim: int, parts: int) -> list[int]:
    """Ends of equal parts; where the length does not divide, parts differ by one."""
    return [dim * i // parts for i in range(parts + 1)]


def _batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield part, matrix(part.column("x"), dim)


def _sums(rows: DataFrame, books: list[np.ndarray], dim: int, cell: int) -> DataFrame:
    """(part, entry, n, sums) of the vectors assigned to every entry."""
    ends = cuts(dim, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigners = [Assigner(b, cell) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, np.int64) for b in books]
        for _, x in _batches(batches, dim):
            for p, a in enumerate(assigners):
                part = x[:, ends[p]:ends[p + 1]]
                index, _ = a.nearest(part)
                counts[p] += np.bincount(index, minlength=len(books[p]))
                np.add.at(totals[p], index, part)
        out = [(p, e, int(counts[p][e]), totals[p][e]) for p in range(len(books)) for e in np.nonzero(counts[p])[0].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                          pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.list_(pa.int64()))],
                                         ["part", "entry", "n", "sums"])
    return rows.select("x").mapInArrow(run, "part int, entry int, n long, sums array<long>")


def train(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cell: int = CELL) -> list[np.ndarray]:
    """The codebooks, one array (entries, part length) per part position; ``rows`` has vec_id and x of length ``dim``."""
    ends = cuts(dim, parts)
    first = np.array([r["x"] for r in rows.orderBy("vec_id", "x").limit(entries).collect()], np.int64).reshape(-1, dim)
    books = [first[:, a:b].copy() for a, b in zip(ends, ends[1:])]
    for _ in range(rounds):
        flat = _sums(rows, books, dim, cell).select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
        # sums of partial sums: decimals cannot overflow, whatever the number of rows
        total = flat.groupBy("part", "entry", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        for r in total.collect():  # parts x entries x part length numbers at most
            books[r["part"]][r["entry"], r["at"]] = int(r["s"]) // r["n"]
    return books


def assign(rows: DataFrame, books: list[np.ndarray], dim: int, keep: tuple[str, ...] = (), cell: int = CELL) -> DataFrame:
    """(vec_id, code, error) and ``keep``: two hex digits per part, and the squared distances summed over the parts."""
    ends, names = cuts(dim, len(books)), ["vec_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigners = [Assigner(b, cell) for b in books]
        for batch, x in _batches(batches, dim):
            error, digits = np.zeros(len(x), np.int64), np.empty((len(x), len(books)), np.uint8)
            for p, a in enumerate(assigners):
                index, distance = a.nearest(x[:, ends[p]:ends[p + 1]])
                error += distance
                digits[:, p] = index
            code = [d.tobytes().hex() for d in digits]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(code, pa.string()), pa.array(error)], [*names, "code", "error"])
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) + ", code string, error long"
    return rows.select(*names, "x").mapInArrow(run, schema)


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cell: int = CELL) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256): one row per vector that takes part, repeated rows included.

    Null, empty or non-finite vectors, null ids and components beyond ``integers.limit`` take no part; of vectors of several
    lengths, those as long as the one with the smallest (vec_id, length). Fewer vectors than ``entries`` give as many entries.
    ``label_error`` sums the errors of equal labels, null being a label; it is null if the sum leaves 64 bits. Up to 256
    entries. An empty table gives an empty result; other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256: a code has two hex digits a part")
    every = stored(integer_vectors(df, scale, (F.col(label_col).alias("label"),), id_col, vec_col), "codes-integers")
    first = every.orderBy("vec_id", "dim").select("dim").limit(1).collect()
    if not first:
        return every.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"),
                            F.lit(digest([])).alias("codebooks_sha256"))
    dim = first[0]["dim"]
    rows = every.where(F.col("dim") == dim)
    books = train(rows, dim, parts, entries, rounds, cell)
    coded = stored(assign(rows, books, dim, ("label",), cell), "codes-assigned")
    # one row per label, added up before any shuffle; written, so that Spark knows whether it is small enough to broadcast
    sums = stored(coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")), "codes-labels")
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return out.withColumn("codebooks_sha256", F.lit(digest(books)))


def oracle(scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB twin of ``compress`` for vectors whose length the parts divide."""
    ctes = [f"""kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x, len(embedding) // {parts} AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
v AS MATERIALIZED (
  SELECT vec_id, (i - 1) // w AS p, (i - 1) % w AS j, x[i] AS c FROM (SELECT vec_id, x, w, unnest(range(1, len(x) + 1)) AS i FROM kept)),
b0 AS MATERIALIZED (
  SELECT p, e, j, c FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, struct_pack(d := d, e := e)) AS e, min(d) AS d
  FROM (SELECT vec_id, v.p, b.e, CAST(sum((v.c - b.c) * (v.c - b.c)) AS BIGINT) AS d FROM v JOIN b{r} AS b ON v.p = b.p AND v.j = b.j GROUP BY ALL)
  GROUP BY vec_id, p)""")
        if r < rounds:
            ctes.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, coalesce(m.c, b.c) AS c
  FROM b{r} AS b LEFT JOIN (
    SELECT p, e, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c
    FROM (SELECT a.p, a.e, v.j, sum(v.c) AS s, count(*) AS n FROM a{r} AS a JOIN v USING (vec_id, p) GROUP BY ALL)) AS m USING (p, e, j))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
JOIN kept USING (vec_id), (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds})"""

import hashlib

import numpy as np
import pytest

from spanlog.llm import codes
from spanlog.llm.integers import limit
from spanlog.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int, error string"


def brute(rows, scale=4096, parts=8, entries=16, rounds=6):
    kept = [(i, [int(np.floor(scale * float(np.float32(c)))) for c in v], lab) for i, v, lab in rows
            if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    dim = min((i, len(v)) for i, v, _ in kept)[1]
    kept = [r for r in kept if len(r[1]) == dim]
    ends = [dim * p // parts for p in range(parts + 1)]

    def cut(v, p):
        return v[ends[p]:ends[p + 1]]
    books = [[cut(v, p) for _, v, _ in sorted((i, v, 0) for i, v, _ in kept)[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), n) for n, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(v, p)[1] for _, v, _ in kept]
            books[p] = [[sum(c) // len(c) for c in zip(*members)] if (members := [cut(v, p) for (_, v, _), o in zip(kept, of) if o == n]) else e
                        for n, e in enumerate(books[p])]
    out = []
    for i, v, lab in kept:
        near = [nearest(v, p) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in near), sum(d for d, _ in near), lab))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(i, c, e, sum(x[2] for x in out if x[3] == lab), sha) for i, c, e, lab in out])


def result(df):
    return sorted(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def odd_rows(dim=16):
    rng = np.random.default_rng(5)
    same = [0.25, -0.5] * (dim // 2)
    rows = [(i, (rng.standard_normal(dim) / 4).tolist(), int(i % 3) if i % 5 else None) for i in range(150)]
    rows += [(i, same, 1) for i in range(200, 260)] + [(200, same, 1), (3, same, 2)]
    return rows + [(300, None, 1), (301, [], 1), (302, [float("nan")] * dim, 1), (303, [None] * dim, 1), (304, [float("inf")] + [0.0] * (dim - 1), 1),
                   (305, [0.0] * dim, None), (306, [1.0, 2.0], 1), (None, same, 1)]


@pytest.mark.parametrize("dim", [16, 20])
def test_equals_plain_rounds(spark, dim):
    rows = odd_rows(dim)
    df = spark.createDataFrame([(i, v, lab, "?", 1, "?") for i, v, lab in rows], SCHEMA)
    for cell in (512, 64, 1 << 20):
        assert result(codes.compress(df, cell=cell)) == brute(rows)


def test_few_rows_and_empty_tables(spark):
    rows = [(5, [1.0] * 8, None), (2, [0.5] * 8, None), (9, [0.75] * 8, 1)]
    df = spark.createDataFrame([(i, v, lab, "", 0, "") for i, v, lab in rows], SCHEMA)
    assert result(codes.compress(df)) == brute(rows)
    empty = codes.compress(df.limit(0))
    assert empty.count() == 0 and empty.columns == codes.compress(df).columns
    far = spark.createDataFrame([(1, [1e30] * 8, 1, "", 0, ""), (2, [1.0] * 8, 1, "", 0, "")], SCHEMA)
    assert [r["vec_id"] for r in codes.compress(far).collect()] == [2]
    with pytest.raises(ValueError):
        codes.compress(df, entries=300)


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert result(QUERIES["op11_vector_codes"](spark, sf)) == brute(rows)


def test_cells_keep_every_nearest_entry_and_save_work():
    rng = np.random.default_rng(6)
    entries = rng.integers(-2000, 2000, (16, 8))
    x = (entries[rng.integers(0, 16, 5000)] + rng.integers(-150, 150, (5000, 8))).astype(np.int64)
    d = ((x[:, None] - entries) ** 2).sum(axis=2)
    for cells in (1 << 16, 50):  # a full memory is emptied
        a = codes.Assigner(entries, cell=512, cells=cells)
        index, least = a.nearest(x)
        assert (index == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert codes.Assigner(entries).nearest(x[:0])[0].size == 0
    a = codes.Assigner(entries)
    for _ in range(3):
        a.nearest(x)
    assert a.cells < len(x) and a.evaluated < 3 * len(x) * 16 / 4  # boxes are decided once, and most entries are out
    ties = codes.Assigner(np.array([[0, 4], [4, 0], [4, 0]]), cell=8)
    assert ties.nearest(np.array([[2, 2], [4, 0], [0, 4]]))[0].tolist() == [0, 1, 0]


def test_colliding_hashes_are_told_apart():
    entries = np.array([[0, 0], [1000, 1000]])
    a = codes.Assigner(entries, cell=16)
    a.mix[:] = 0  # every cell has one hash
    x = np.array([[0, 0], [1000, 1000], [999, 990]])
    assert a.nearest(x)[0].tolist() == [0, 1, 1] and a.nearest(x[::-1].copy())[0].tolist() == [1, 1, 0]


def test_components_stay_exact():
    assert limit(64) ** 2 * 64 <= 2 ** 51 < (limit(64) + 1) ** 2 * 64

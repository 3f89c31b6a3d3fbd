import numpy as np
from pyspark.sql import functions as F

from spanlog.llm import ann, topk
from spanlog.llm.queries import QUERIES


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "?", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int")


def brute(rows, integers, k=20, zero=True):
    keep = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    keep = [(i, np.floor(64 * v) if integers else v) for i, v in keep if zero or v.any()]
    out = {}
    for q, x in keep:
        if q % 20 == 0:
            scored = sorted({(-float((x * y).sum()), i) for i, y in keep if i != q and len(x) == len(y)})
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def odd_rows():
    rng = np.random.default_rng(3)
    same = rng.standard_normal(8).tolist()
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(120)] + [(i, same) for i in range(200, 270)]
    return rows + [(300, None), (320, []), (340, [float("nan")] * 8), (360, [None] * 8), (380, [0.0] * 8), (400, [1.0, 2.0]), (401, [3.0, -1.0]),
                   (420, [float("inf")] + [0.0] * 7), (None, same), (200, same)]


def test_exact_top_k_equals_brute_force(spark):
    rows = odd_rows()
    for block in (8192, 16):
        got = result(topk.top(frame(spark, rows), F.col("vec_id") % 20 == 0, block_rows=block, query_rows=block))
        assert got == brute(rows, True)
    assert topk.top(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(4)
    x, q = rng.integers(-64, 64, (300, 24)).astype(float), rng.integers(-64, 64, (40, 24)).astype(float)
    exact, last = q @ x.T, None
    for segments in topk.LEVELS:
        bound = topk.statistics(q, segments) @ topk.statistics(x, segments).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or (bound <= last + 1e-6).all()  # finer levels are tighter
        last = bound


def test_neighbours_on_odd_rows(spark):
    rows = odd_rows()
    want = brute(rows, False, zero=False)
    got = result(ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0))
    assert set(got) == set(want)
    for q, near in got.items():
        assert len(near) == len(want[q]) and len({i for i, _ in near}) == len(near)
        assert near == sorted(near, key=lambda p: (-p[1], p[0]))
    copies = [q for q in got if 200 <= q < 270]
    assert copies and all(got[q] == [(i, s) for i, s in want[q]] for q in copies)  # equal vectors: ties to the smaller ids
    assert ann.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    got, hits, total = result(QUERIES["op3_collision_ann"](spark, sf)), 0, 0
    for q in ids[ids % 20 == 0].tolist():
        s = (x * x[np.nonzero(ids == q)[0][0]]).sum(axis=1)
        best = [int(ids[i]) for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        hits, total = hits + len({i for i, _ in got[q]} & set(best)), total + 20
    assert hits / total >= 0.9

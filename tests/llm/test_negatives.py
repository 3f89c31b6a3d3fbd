import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlog.llm import negatives as N
from spanlog.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, want int, cell int, negative_id string"


def relabelled():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def brute(rows):
    v = {}
    for i, x, lab in rows:
        if i is None or lab is None or not x or any(c is None or not np.isfinite(c) for c in x):
            continue
        r = ((lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * float(np.float32(c)))) for c in x])
        v[i] = min(v[i], r) if i in v else r
    out = []
    for a, (lab, x) in v.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in v.items() if i != a and len(x) == len(y))
        for s, i, _ in [t for t in scored if t[2] == lab][:5]:
            fit = [(n, -m) for m, n, other in scored if other != lab and 30 * -s <= 100 * -m <= 90 * -s]
            out += [(a, i, r + 1, n, -s, m) for r, (n, m) in enumerate(fit[:10])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, lab, 1, 1, 1, "?") for i, x, lab in rows], SCHEMA)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def odd_rows():
    rng = np.random.default_rng(8)
    same = [0.5, 0.25, -0.5, 0.125, 0.0, 0.3, 0.4, -0.1]
    centres = rng.standard_normal((6, 8))
    rows = [(i, (centres[i % 6] + rng.standard_normal(8) / 3).tolist(), int(rng.integers(0, 10))) for i in range(700)]
    rows += [(i, same, i % 3) for i in range(1000, 1400)] + [(1000, same, 0), (1100, same, 5), (100, same, 9)]
    return rows + [(1500, None, 1), (1600, [], 1), (1700, [float("nan")] * 8, 1), (1800, [None] * 8, 1), (1900, [0.0] * 8, 2), (2000, same, None),
                   (2100, [float("inf")] + [0.0] * 7, 1), (2200, [1.0, 2.0], 3), (2201, [2.0, 1.0], 3), (2202, [1.0, 1.0], 4), (None, same, 1)]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 50, "batch_rows": 2, "members": 1}, {"block_rows": 100, "members": 4}])
def test_equals_brute_force(spark, sizes):
    rows = odd_rows()
    got = result(N.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, relabelled(), **sizes))
    assert got == brute(rows) and got


def test_query_and_empty_tables(spark, tmp_path):
    rows = odd_rows()
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert result(QUERIES["op13_hard_negatives"](spark, str(tmp_path))) == brute(rows)
    some = N.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, relabelled())
    for none in (frame(spark, []), frame(spark, [r for r in rows if r[0] is not None and r[0] % 100])):
        out = N.mine(none, F.col("vec_id") % 100 == 0, relabelled())
        assert out.count() == 0 and out.columns == some.columns


def test_walks_end_early_where_vectors_cluster():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((20, 32)) * 50
    of = rng.integers(0, 20, 20_000)
    x = np.floor(centres[of] + rng.standard_normal((20_000, 32)) * 4)
    labels, ids = rng.integers(0, 5, 20_000), np.arange(20_000)
    q = x[:64]  # members of all clusters, searched cluster by cluster
    work = 0
    for c in np.unique(of[:64]):
        m = np.nonzero(of[:64] == c)[0]
        needs = N.Needs(q[m], ids[m], labels[m], np.full(len(m), -np.inf), np.full(len(m), np.inf), True, 5)
        need, score, near, done = N.walk(x, ids, labels, N.unit(centres[c:c + 1])[0], needs)
        work += done
        exact = q[m] @ x.T
        for n in range(len(m)):
            ok = (labels == labels[m[n]]) & (ids != m[n])
            want = sorted(zip(-exact[n][ok], ids[ok]))[:5]
            assert sorted(zip(-score[need == n], near[need == n])) == want
    assert work < 0.3 * 64 * len(x)


def test_cells_that_cannot_reach_are_left_out(spark):
    rng = np.random.default_rng(10)
    centres = np.eye(16)[:8] * 2
    rows = [(i, (centres[i % 9 % 8] + rng.standard_normal(16) / 50).tolist(), i % 2) for i in range(4000)]
    df = frame(spark, rows)
    ints = N.integer_vectors(df, 256, ("label",)).withColumn("is_anchor", F.col("vec_id") % 100 == 0)
    s = N.Search(ints.drop("dim"), ints.where("is_anchor"), 16, 40, 500, 10, 8, 5)
    assert len(s.cells) == 8
    high = {c: 400.0 for c in s.batches_of}  # scores that only rows of an anchor's own direction reach
    pairs = s.pairs(high)
    assert pairs == {c: [c] for c in s.cells}
    assert s.pairs({c: float("-inf") for c in s.batches_of}) == {b: list(s.batches_of) for b in s.cells}

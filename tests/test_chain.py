"""Chained rolling snapshots against D7: every bucket, repeated and odd rows, extension, what is stored."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from spanlog.model import HISTORY_SCHEMA
from spanlog.operators.travel import rolling_snapshots
from spanlog.sources.chain import BASE_SHARE, ENTRY, SnapshotChain

OPEN = datetime(2199, 12, 31)
START, MIDDLE, END = "2024-01-01 00:00:00", "2024-01-20 00:00:00", "2024-02-15 12:00:00"


def _history(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a = datetime(2023, 12, 28) + timedelta(hours=r.randrange(1100))
        b = r.choice([OPEN, a + timedelta(hours=r.randrange(600)), a + timedelta(minutes=30), a])
        rows.append((i, i % 50, r.choice("ffffd"), "./hot/" if i % 3 else f"./d{i % 9}/", f"n{i % 40}", a, b, 0))
    rows += [(900, 1, "f", "./twin/", "x", datetime(2024, 1, 3), OPEN, 0)] * 3 + [(901, 1, "f", "./twin/", "x", datetime(2024, 1, 3), datetime(2024, 1, 9), 0)] * 2
    return rows + [(902, None, "f", None, "n", datetime(2024, 1, 5), OPEN, 0), (903, 1, None, "./t/", "n", datetime(2024, 1, 5), OPEN, 0)]


def _rows(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


def test_every_bucket_equals_the_rolling_snapshots(spark, tmp_path):
    rows = _history(1, 300)
    h = spark.createDataFrame(rows, HISTORY_SCHEMA)
    middle = datetime(2024, 1, 20)
    known = [(*r[:6], r[6] if r[6] <= middle else OPEN, 0) for r in rows if r[5] <= middle]
    chain = SnapshotChain(spark, f"{tmp_path}/c", "day")
    assert chain.extend(spark.createDataFrame(known, HISTORY_SCHEMA), MIDDLE, start=START) == 20
    assert chain.extend(h, END) == 26 and chain.extend(h, END) == 0
    want = rolling_snapshots(h, "day", START, END).select("bucket", "boundary", *ENTRY)
    assert _rows(chain.all_snapshots()) == _rows(want)
    for day in ("2024-01-01", "2024-01-09", "2024-01-20", "2024-01-21", "2024-02-15"):
        assert _rows(chain.snapshot(f"{day} 00:00:00")) == _rows(want.where(F.col("bucket") == day).select(*ENTRY))


def test_stored_rows_grow_with_changes_not_with_boundaries(spark, tmp_path):
    """A thousand versions that stay, three that change: over two years of days as over a month."""
    still = [(i, i, "f", "./a/", f"n{i}", datetime(2024, 1, 1), OPEN, 0) for i in range(1000)]
    moving = [(2000 + i, i, "f", "./b/", f"m{i}", datetime(2024, 1, 10 + i), datetime(2024, 1, 20 + i), 0) for i in range(3)]
    h = spark.createDataFrame(still + moving, HISTORY_SCHEMA)
    chain = SnapshotChain(spark, f"{tmp_path}/c", "day")
    assert chain.extend(h, "2025-12-31 00:00:00", start=START) == 731
    stored = {k: chain.rows(k).count() for k in ("adds", "removes", "bases")}
    assert stored == {"adds": 1003, "removes": 3, "bases": 1000} and chain.bases() == [START]
    assert chain.snapshot("2025-06-01 00:00:00").count() == 1000 and chain.snapshot("2024-01-20 00:00:00").count() == 1002


def test_bases_keep_the_changes_to_read_in_proportion(spark, tmp_path):
    h = spark.createDataFrame(_history(2, 400), HISTORY_SCHEMA)
    chain = SnapshotChain(spark, f"{tmp_path}/c", "day")
    chain.extend(h, END, start=START)
    day = F.date_format("boundary", "yyyy-MM-dd HH:mm:ss")
    changes = [(r[0], r[1]) for k in ("adds", "removes") for r in chain.rows(k).groupBy(day).agg(F.sum("copies")).collect()]
    size = {str(r[0]): r[1] for r in chain.all_snapshots().groupBy("boundary").count().collect()}
    bases = chain.bases()
    assert len(bases) > 1
    for t, n in size.items():
        base = max(b for b in bases if b <= t)
        assert sum(c for b, c in changes if base < b <= t) <= BASE_SHARE * max(n, 1)
    assert chain.rows("bases").agg(F.sum("copies")).head()[0] <= sum(c for _, c in changes) / BASE_SHARE + size[str(bases[0])]


def test_an_empty_history_gives_empty_snapshots(spark, tmp_path):
    chain = SnapshotChain(spark, f"{tmp_path}/c", "month")
    assert chain.extend(spark.createDataFrame([], HISTORY_SCHEMA), "2024-06-15 00:00:00", start="2024-01-02 00:00:00") == 5
    assert chain.snapshot("2024-02-01 00:00:00").count() == 0 and chain.all_snapshots().count() == 0

"""Property tests: operators against their definitions or a plain loop."""

import datetime as dt
import random
from bisect import bisect_right

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, hist_rows, inv_rows
from spanlog.model import OPEN_TEXT, empty_history
from spanlog.operators import checks as H
from spanlog.operators import history as B
from spanlog.operators import travel as D
from spanlog.plans import fixtures as X
from spanlog.plans.ordered import keyed_scan
from spanlog.streaming import debounce as L

OPEN = dt.datetime.fromisoformat(OPEN_TEXT)


def _boundary_class(c: dt.datetime, d: dt.datetime) -> int | None:
    """Coarsest grain with a boundary B, c <= B < d (the class definition), else the tail."""
    if d == OPEN:
        return 0

    def next_month(x):
        y, m = (x.year + (x.month == 12), 1 if x.month == 12 else x.month + 1)
        first = x.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
        return first if first >= x else dt.datetime(y, m, 1)

    def next_step(x, floor, step):
        f = floor(x)
        return f if f >= x else f + step

    day = lambda x: x.replace(hour=0, minute=0, second=0, microsecond=0)
    week = lambda x: day(x) - dt.timedelta(days=x.weekday())
    hour = lambda x: x.replace(minute=0, second=0, microsecond=0)
    five = lambda x: x.replace(minute=x.minute - x.minute % 5, second=0, microsecond=0)
    if next_month(c) < d:
        return 1
    if next_step(c, week, dt.timedelta(days=7)) < d:
        return 5
    if next_step(c, day, dt.timedelta(days=1)) < d:
        return 30
    if next_step(c, hour, dt.timedelta(hours=1)) < d:
        return 720
    if next_step(c, five, dt.timedelta(minutes=5)) < d:
        return 8640
    span = int((d - c).total_seconds())
    return None if span == 0 else int(2592000 / span)


def test_freq_class_is_boundary_definition(spark):
    rnd = random.Random(7)
    base = dt.datetime(2023, 12, 20)
    rows = []
    for i in range(3000):
        c = base + dt.timedelta(seconds=rnd.randrange(0, 60 * 86400))
        span = rnd.choice([0, 1, 59, 299, 300, 3599, 3600, 86399, 86400, 7 * 86400, 40 * 86400])
        d = c + dt.timedelta(seconds=rnd.randrange(0, span + 1))
        rows.append((i, i, "f", "./", "x", str(c), str(d)))
    rows.append((99999, 1, "f", "./", "x", "2024-01-01 00:00:00", None))
    h = hist_rows(spark, rows)
    for r in h.collect():
        assert r.freq == _boundary_class(r.created, r.deleted), (r.created, r.deleted, r.freq)


def test_keyed_scan_matches_windows_with_hot_key(spark):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.4 else rnd.randrange(1, 30), i, rnd.choice([None, rnd.randrange(100)]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    s = keyed_scan(df, ["k"], ["t"], lag=["v"], ffill=["v"], cumsum=["t"], partitions=7)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("r_lag"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r_ff"),
                    F.sum("t").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r_cs"))
    j = s.join(ref, ["k", "t"])
    assert j.count() == 3000
    bad = j.filter(~F.col("lag_v").eqNullSafe(F.col("r_lag")) | ~F.col("ffill_v").eqNullSafe(F.col("r_ff"))
                   | (F.col("cumsum_t") != F.col("r_cs")))
    assert bad.count() == 0


def test_debounce_matches_loop(spark):
    e = X._t(spark, SF_SMALL, "events").select("user_id", "ts", "event_id")
    for gap, mx in [(3600, 4 * 3600), (6 * 3600, 6 * 3600), (600, 86400)]:
        got = sorted((r.key, r.batch_start, r.fire_at, r.n_events)
                     for r in L.debounce(e, "user_id", "ts", gap, mx).collect())
        ev = sorted((r.user_id, r.ts, r.event_id) for r in e.collect())
        us = [(k, int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)) for k, t, _ in ev]
        want = L.debounce_loop(us, gap * 1_000_000, mx * 1_000_000)
        conv = sorted((k, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=a),
                       dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=b), n) for k, a, b, n in want)
        assert got == conv


def _busy_loop(events, gap, mx, run):
    out = []
    for key in sorted({k for k, _ in events}):
        ts = [t for k, t in events if k == key]
        t0 = fire = None
        n, busy = 0, None
        for t in ts:
            while t0 is not None and fire <= t:
                if busy is not None and fire < busy:
                    fire += gap
                else:
                    out.append((key, t0, fire, n))
                    busy, t0, n = fire + run, None, 0
            if t0 is None:
                t0, fire, n = t, t + gap, 1
            else:
                if t - t0 < mx - gap:
                    fire = t + gap
                n += 1
        if t0 is not None:
            while busy is not None and fire < busy:
                fire += gap
            out.append((key, t0, fire, n))
    return sorted(out)


def test_busy_coalesce_matches_loop(spark):
    e = X._t(spark, SF_SMALL, "events").select("user_id", "ts", "event_id")
    gap, mx, run = 3600, 4 * 3600, 5 * 3600
    got = sorted((r.key, r.batch_start, r.run_start, r.n_events)
                 for r in L.busy_coalesce(e, "user_id", "ts", gap, mx, run).collect())
    ev = sorted((r.user_id, r.ts, r.event_id) for r in e.collect())
    us = [(k, int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)) for k, t, _ in ev]
    want = _busy_loop(us, gap * 10**6, mx * 10**6, run * 10**6)
    ep = dt.datetime(1970, 1, 1)
    assert got == sorted((k, ep + dt.timedelta(microseconds=a), ep + dt.timedelta(microseconds=f), n)
                         for k, a, f, n in want)


def test_series_equals_folded_snapshots_and_as_of(spark):
    days = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]
    listings = [
        [(1, "f", "./", "a"), (2, "f", "./", "b")],
        [(1, "f", "./", "a"), (3, "f", "./", "b"), (4, "d", "./", "c")],
        [],
        [(1, "f", "./", "a"), (2, "f", "./", "b")],
    ]
    snaps = spark.createDataFrame([(d, *r) for d, rows in zip(days, listings) for r in rows],
                                  "t string, inode long, type string, dirname string, filename string") \
        .withColumn("t", F.to_timestamp("t"))
    times = spark.createDataFrame([(d,) for d in days], "t string").withColumn("t", F.to_timestamp("t"))
    s = B.series_to_history(snaps, times)
    h = empty_history(spark)
    for d, rows in zip(days, listings):
        h = B.apply_snapshot(h, inv_rows(spark, rows), d).history
        h = spark.createDataFrame(h.collect(), h.schema)
    cols = ["inode", "type", "dirname", "filename", "created", "deleted", "freq"]
    assert sorted(map(tuple, s.select(cols).collect())) == sorted(map(tuple, h.select(cols).collect()))
    for d, rows in zip(days, listings):
        at = D.snapshot_as_of(s.filter(F.col("type") != "d"), d, "./")
        assert sorted((r.inode, r.filename) for r in at.collect()) == sorted(
            (r[0], r[3]) for r in rows if r[1] != "d")


def test_reapplying_listing_changes_nothing(spark):
    inv = inv_rows(spark, [(1, "f", "./", "a"), (2, "f", "./d/", "b")])
    h1 = B.apply_snapshot(empty_history(spark), inv, "2024-01-01 00:00:00").history
    h1 = spark.createDataFrame(h1.collect(), h1.schema)
    h2 = B.apply_snapshot(h1, inv, "2024-01-02 00:00:00").history
    assert sorted(map(tuple, h1.collect())) == sorted(map(tuple, h2.collect()))


def test_repairs_leave_checks_empty(spark):
    h = X.hist_overlap(spark, SF_SMALL)
    r = H.repair_all(h, X.live_obj(spark, SF_SMALL), X.store_obj(spark, SF_SMALL))
    h2, live, store = r["history"], r["live"], r["store"]
    h2 = spark.createDataFrame(h2.collect(), h2.schema)
    assert H.check_db2current(h2, live).count() == 0
    assert H.check_db2old(h2, store).count() == 0
    assert H.check_old2db(store, h2).count() == 0
    assert H.check_old2current(store, live).count() == 0
    assert H.check_overlaps(h2).count() == 0
    assert H.check_dups_created(h2).count() == 0


def _grid(freq, start, end):
    """Grid times of a class from ``start`` to before ``end``."""
    if freq == 1:
        return [g for n in range(1200) for m in [start.month - 1 + n] if (g := start.replace(year=start.year + m // 12, month=m % 12 + 1)) < end]
    width = {5: dt.timedelta(days=7), 30: dt.timedelta(days=1), 720: dt.timedelta(hours=1), 8640: dt.timedelta(minutes=5), 43800: dt.timedelta(minutes=1)}[freq]
    return [start + n * width for n in range(max(0, -((start - end) // width)))]


def _timeline(changes, segs):
    """By definition: a grid time is shown if a change lies at or before it, but after every grid time looked at before.

    Looked at before are the smaller grid times of the segment and all grid times of the segments before it, back to the last
    one that starts earlier than its predecessor."""
    ends = [start for _, start in segs[1:]] + [changes[-1]]
    grids = [_grid(f, start, end) for (f, start), end in zip(segs, ends, strict=True)]
    shown = []
    for i, (f, start) in enumerate(segs):
        first = max([k for k in range(1, i + 1) if segs[k][1] < segs[k - 1][1]], default=0)
        before = max([g for grid in grids[first:i] for g in grid], default=dt.datetime.min)
        for g in grids[i]:
            if bisect_right(changes, g) > bisect_right(changes, before):
                shown.append((f, g))
            before = max(before, g)
    return sorted(shown)


def test_thin_timeline_matches_its_definition(spark):
    h = X.hist_events(spark, SF_SMALL)
    ch = D.change_points(h)
    st = D.timeline_starts(h)
    got = {}
    for r in D.thin_timeline(ch, st).collect():
        got.setdefault(r.dirname, []).append((r.freq, r.t))
    chs, sts = {}, {}
    for r in ch.collect():
        chs.setdefault(r.dirname, []).append(r.t)
    for r in st.collect():
        sts.setdefault(r.dirname, []).append((r.freq, r.start))
    for dname, segs in sts.items():
        want = _timeline(sorted(chs[dname]), sorted(segs))
        assert sorted(got.get(dname, [])) == want, dname


def test_budget_frees_enough_and_is_minimal(spark):
    from spanlog.operators import retention as R
    es = X.event_sizes(spark, SF_SMALL)
    sc = R.retention_score(es, X.NOW_EVENTS)
    total = sc.agg(F.sum("size")).first()[0]
    need = total // 4
    v = R.retention_budget(sc, need).collect()
    freed = sum(r.size for r in v)
    assert freed >= need
    assert freed - max(r.size for r in v if r.freed_before == max(x.freed_before for x in v)) < need


def test_keyed_scan_key_spanning_many_partitions(spark):
    rnd = random.Random(11)
    rows = [(0 if rnd.random() < 0.7 else rnd.randrange(1, 5), i,
             rnd.randrange(100) if rnd.random() < 0.02 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    s = keyed_scan(df, ["k"], ["t"], lag=["v"], ffill=["v"], cumsum=["t"], partitions=41)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("r_lag"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r_ff"),
                    F.sum("t").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r_cs"))
    j = s.join(ref, ["k", "t"])
    bad = j.filter(~F.col("lag_v").eqNullSafe(F.col("r_lag")) | ~F.col("ffill_v").eqNullSafe(F.col("r_ff"))
                   | (F.col("cumsum_t") != F.col("r_cs")))
    assert j.count() == 4000 and bad.count() == 0


def test_hot_key_is_split_evenly(spark):
    """Measured after the scan: its output partitions, not the ranges before it."""
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.6 else rnd.randrange(1, 100), i) for i in range(20000)]
    df = spark.createDataFrame(rows, "k long, t long")
    s = keyed_scan(df, ["k"], ["t"], lag=["t"], partitions=8)
    sizes = [row["count"] for row in s.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8
    assert max(sizes) < 2 * (20000 / 8), sizes
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_pid" not in plan


def test_dups_repair_keeps_one_version_per_start(spark):
    rows = [(1, 10, "f", "./a/", "x", "2024-01-01 00:00:00", "2024-01-02 00:00:00"), (2, 11, "f", "./a/", "x", "2024-01-01 00:00:00", None),
            (3, 12, "f", "./a/", "y", "2024-01-01 00:00:00", None), (3, 13, "f", "./a/", "z", "2024-01-01 00:00:00", None),
            (4, 14, "f", "./a/", "z", "2024-01-01 00:00:00", None)]
    kept = H.repair_dups_created(hist_rows(spark, rows))
    assert sorted((r.row_id, r.inode, r.filename) for r in kept.collect()) == [(1, 10, "x"), (3, 12, "y"), (4, 14, "z")]
    assert H.check_dups_created(kept).count() == 0


def test_versions_that_share_a_row_id_are_told_apart(spark):
    rows = [(7, 1, "f", "./a/", "x", "2024-01-01 00:00:00", "2024-01-05 00:00:00"), (8, 2, "f", "./a/", "x", "2024-01-03 00:00:00", None),
            (7, 3, "f", "./b/", "y", "2024-01-01 00:00:00", None)]
    h = hist_rows(spark, rows)
    fixed = {(r.dirname, r.inode): r.deleted for r in H.repair_overlaps(h).collect()}
    assert fixed["./a/", 1] == dt.datetime(2024, 1, 3) and fixed["./b/", 3].year == 2199
    live = inv_rows(spark, [(3, "f", "./b/", "y")])
    left = H.repair_db2current(h, live).collect()
    assert sorted(r.inode for r in left) == [1, 3]


def test_series_with_repeated_rows_equals_the_fold(spark):
    rnd = random.Random(3)
    times = [f"2024-01-{d:02d} 00:00:00" for d in range(1, 9)]
    lists = [[(rnd.randrange(4), "f", "./a/", rnd.choice("pqr")) for _ in range(rnd.randrange(7))] for _ in times]
    lists[3] = []
    schema = "inode long, type string, dirname string, filename string"
    series = spark.createDataFrame([(t, *r) for t, rows in zip(times, lists, strict=True) for r in rows], "t string, " + schema)
    series = series.withColumn("t", F.to_timestamp("t"))
    ticks = spark.createDataFrame([(t,) for t in times], "t string").select(F.to_timestamp("t").alias("t"))
    got = B.series_to_history(series, ticks).collect()
    h = empty_history(spark)
    for t, rows in zip(times, lists, strict=True):  # B6 for each listing; its result is cut off from the plan
        h = spark.createDataFrame(B.apply_snapshot(h, spark.createDataFrame(sorted(set(rows)), schema), t).history.collect(), h.schema)
    cols = ("inode", "type", "dirname", "filename", "created", "deleted", "freq")
    assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(tuple(r[c] for c in cols) for r in h.collect())


def test_lines_follow_the_files(spark, tmp_path):
    from spanlog.sources.files import read_lines
    (tmp_path / "a.txt").write_text("a1\na2\n")
    (tmp_path / "b.txt").write_text("".join(f"b{i:03d}\n" for i in range(300)))
    got = [(r.seq, r.value) for r in read_lines(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == list(enumerate(["a1", "a2"] + [f"b{i:03d}" for i in range(300)]))


def test_overlaps_match_brute_force(spark):
    rnd = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        c = base + dt.timedelta(minutes=rnd.randrange(0, 500))
        kind = rnd.random()
        if kind < 0.2:
            d = c                                            # zero-length
        elif kind < 0.3:
            d = c - dt.timedelta(minutes=rnd.randrange(1, 30))  # inverted
        else:
            d = c + dt.timedelta(minutes=rnd.randrange(1, 60))
        rows.append((i, i, "f", "./", f"p{rnd.randrange(3)}", str(c), str(d)))
    h = hist_rows(spark, rows)
    got = {r.row_id: r.next_created for r in H.check_overlaps(h).collect()}
    want = {}
    parsed = [(r[0], r[4], dt.datetime.fromisoformat(r[5]), dt.datetime.fromisoformat(r[6])) for r in rows]
    for a in parsed:
        cands = [b[2] for b in parsed if b[1] == a[1] and a[2] < b[2] and a[2] < b[3] and b[2] < a[3]]
        if cands:
            want[a[0]] = min(cands)
    assert got == want


def test_overlaps_of_a_path_with_many_inverted_versions(spark):
    """30,000 inverted versions of one path (900 million pairs with its versions): the scan gives the answer of a sorted walk."""
    n = 30_000
    rows = [(i, i, "f", "./", "hot", 1_700_000_000 + (i * 7919) % 400_000, 1_700_000_000 + (i * 7919) % 400_000 + (-(i % 500) - 1 if i % 10 else 60)) for i in range(n)]
    h = spark.createDataFrame(rows, "row_id long, inode long, type string, dirname string, filename string, c long, d long").select(
        "row_id", "inode", "type", "dirname", "filename", F.timestamp_seconds("c").alias("created"), F.timestamp_seconds("d").alias("deleted"))
    got = {r[0]: r[1] for r in H.check_overlaps(h).select("row_id", F.unix_timestamp("next_created")).collect()}
    order = sorted(rows, key=lambda r: -min(r[5], r[6]))
    want, at, least = {}, 0, None
    for r in sorted(rows, key=lambda r: -r[5]):
        while at < n and min(order[at][5], order[at][6]) > r[5]:
            least = order[at][5] if least is None else min(least, order[at][5])
            at += 1
        if least is not None and least < r[6]:
            want[r[0]] = least
    assert got == want and len(want) > 500


def test_a_path_listed_many_times_twice_is_chosen_without_an_array_of_its_listings(spark):
    """600 listings that hold a path with up to four versions, some without it: the choice of a walk; no row holds them together."""
    rnd = random.Random(12)
    rows, want = [], {}
    for path in ("hot", "b"):
        open_one, before = None, -2
        for i in range(600 if path == "hot" else 40):
            if rnd.random() < 0.03:
                continue
            held = sorted({(rnd.choice([1, 1, 1, 2, 3, 4]), rnd.choice("ffd")) for _ in range(rnd.randrange(1, 5))})
            open_one = open_one if before == i - 1 and open_one in held else held[0]
            before, want[(path, i)] = i, open_one
            rows += [(i, *v, "./", path) for v in held for _ in range(rnd.randrange(1, 3))]
    s = spark.createDataFrame(rows, "idx long, inode long, type string, dirname string, filename string").withColumn("t", F.timestamp_seconds("idx"))
    one = B._one_per_path(s)
    assert {(r.filename, r.idx): (r.inode, r.type) for r in one.collect()} == want and one.count() == len(want)


def test_progress_equals_a_count(spark):
    from spanlog.operators.reports import protection_progress
    rows = [(i, i, "f", f"./d{i % 3}/", f"n{i:04d}", "2024-01-01 00:00:00", "2024-02-01 00:00:00") for i in range(730)]
    h = hist_rows(spark, rows)
    secured = h.where(F.pmod("row_id", F.lit(4)) == 1)
    got = sorted(map(tuple, protection_progress(h, secured.unionByName(secured)).collect()))
    order = sorted(rows, key=lambda r: (r[3], r[4]))
    assert got == [(n, sum(r[0] % 4 == 1 for r in order[:n])) for n in range(100, 731, 100)]
    assert protection_progress(h.limit(0), secured).count() == 0

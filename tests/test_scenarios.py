"""The reference's own test scenarios as literal tables (expected rows derived by reading them)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import hist_rows, inv_rows
from spanlog.model import OPEN_TEXT, empty_history
from spanlog.operators import history as B
from spanlog.operators import moves as J
from spanlog.operators import retention as R

T1, T2, T3 = "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 12:00:00"
OPEN = dt.datetime.fromisoformat(OPEN_TEXT)
TRICKY = " tricky _-'\"|$(touch GOTCHA)ы \\ "


def _rows(h):
    return sorted((r.inode, r.type, r.dirname, r.filename, str(r.created), str(r.deleted))
                  for r in h.select("inode", "type", "dirname", "filename", "created", "deleted").collect())


def _apply(spark, steps, scope=None):
    h = empty_history(spark)
    for t, listing, sc in steps:
        h = B.apply_snapshot(h, inv_rows(spark, listing), t, scope=sc).history
        h = spark.createDataFrame(h.collect(), h.schema)  # keep the test plans flat
    return h


def test_s1_tricky_name(spark):
    h = _apply(spark, [(T1, [(1, "f", "./", TRICKY)], None), (T2, [(2, "f", "./", TRICKY)], None),
                       (T3, [(3, "f", "./", "a")], None)])
    got = _rows(h)
    assert got == sorted([
        (1, "f", "./", TRICKY, T1, T2), (2, "f", "./", TRICKY, T2, T3), (3, "f", "./", "a", T3, str(OPEN))])


def test_s2_scoped_run_leaves_other_subtree(spark):
    h = _apply(spark, [(T1, [(1, "f", "./ignore/", "file"), (2, "f", "./use/", "file")], None),
                       (T2, [(4, "f", "./use/", "file")], "use")])
    got = _rows(h)
    assert (1, "f", "./ignore/", "file", T1, str(OPEN)) in got
    assert (2, "f", "./use/", "file", T1, T2) in got
    assert (4, "f", "./use/", "file", T2, str(OPEN)) in got


def test_s3_nested_scope(spark):
    h = _apply(spark, [(T1, [(1, "f", "./ignore/", "file"), (2, "f", "./use/me/", "file"), (3, "f", "./use/", "file")],
                        None),
                       (T2, [(5, "f", "./use/me/", "file")], "use/me")])
    got = _rows(h)
    assert (3, "f", "./use/", "file", T1, str(OPEN)) in got
    assert (1, "f", "./ignore/", "file", T1, str(OPEN)) in got
    assert (2, "f", "./use/me/", "file", T1, T2) in got
    assert (5, "f", "./use/me/", "file", T2, str(OPEN)) in got


def test_s4_file_dir_file(spark):
    h = _apply(spark, [(T1, [(1, "f", "./", "simple")], None), (T2, [(2, "d", "./", "simple")], None),
                       (T3, [(3, "f", "./", "simple")], None)])
    assert _rows(h) == sorted([(1, "f", "./", "simple", T1, T2), (2, "d", "./", "simple", T2, T3),
                               (3, "f", "./", "simple", T3, str(OPEN))])
    assert B.type_changes(h).count() == 1


def test_s5_retention_order(spark):
    a = [(i, "f", "./", f"a{i}") for i in range(1, 5)]
    b = [(10 + i, "f", "./", f"b{i}") for i in range(1, 5)]
    c = [(20 + i, "f", "./", f"c{i}") for i in range(1, 5)]
    t1, t2, t3 = "2024-03-10 10:00:00", "2024-03-10 10:10:00", "2024-03-10 10:20:00"
    h = _apply(spark, [(t1, a + [(31, "f", "./", "x1"), (41, "f", "./", "z1")], None),
                       (t2, a + b + [(32, "f", "./", "y1"), (33, "f", "./", "y2")], None),
                       (t3, a + b + c, None)])
    # z1 back-dated: it becomes a month-class version
    h = h.withColumn("created", F.when(F.col("filename") == "z1", F.to_timestamp(F.lit("2019-01-01 00:00:00")))
                     .otherwise(F.col("created")))
    from spanlog.functions.classes import freq_class
    h = h.withColumn("freq", freq_class("created", "deleted"))
    scored = R.retention_score(h, "2024-03-10 10:30:00").withColumn("size", F.lit(500000).cast("long"))
    order = [r.filename for r in scored.orderBy(F.desc("age"), "dirname", "filename", "created", "row_id").collect()]
    assert order.index("z1") > max(order.index("x1"), order.index("y1"), order.index("y2"))
    v = R.retention_budget(scored, 3 * 500000)
    assert sorted(r.filename for r in v.collect()) == ["x1", "y1", "y2"]


def test_s6_empty_listing_closes_all(spark):
    h = _apply(spark, [(T1, [(1, "f", "./", "a")], None), (T2, [], None)])
    assert _rows(h) == [(1, "f", "./", "a", T1, T2)]


def test_s7_duplicate_path_quarantined(spark):
    r = B.apply_snapshot(empty_history(spark), inv_rows(spark, [(1, "f", "./", "a"), (2, "f", "./", "a")]), T1)
    assert r.history.count() == 1 and r.bad.count() == 1
    assert B.assert_open_unique(r.history).count() == 0


def test_s8_class_edges(spark):
    h = hist_rows(spark, [
        (1, 1, "f", "./", "a", "2018-12-31 23:59:59", "2019-01-01 00:00:00"),
        (2, 2, "f", "./", "b", "2019-01-01 00:00:00", "2019-01-01 00:00:01"),
        (3, 3, "f", "./", "c", "2019-01-01 00:00:00", "2019-01-01 00:00:00"),
        (4, 4, "f", "./", "d", "2019-01-02 10:01:00", "2019-01-02 10:02:00"),
        (5, 5, "f", "./", "e", "2019-01-02 10:01:00", None)])
    got = {r.filename: r.freq for r in h.collect()}
    assert got["a"] != 1
    assert got == {"a": 2592000, "b": 1, "c": None, "d": 43200, "e": 0}


def test_s9_move(spark):
    ch = spark.createDataFrame([
        (1, "new_dir", "new/"), (2, "new_dir", "new/sub/"),
        (3, "new_file", "new/a"), (4, "new_file", "new/b"), (5, "new_file", "new/sub/c"),
        (6, "del_file", "old/a"), (7, "del_file", "old/b"), (8, "del_file", "old/sub/c"),
        (9, "del_dir", "old/sub/"), (10, "del_dir", "old/")], "seq long, op string, path string")
    plan = J.detect_moves(ch).collect()
    assert [(r.old_dir, r.new_dir, r.matches, r.pct) for r in plan] == [("old/", "new/", 3, 100)]
    assert plan[0].line == "cp -al old/ new/ # 3 matched (100%)"

"""Parsers and sinks on literal lines (formats taken from the reference's documents)."""

import datetime as dt

from conftest import SF_SMALL
from spanlog.model import OPEN_TEXT
from spanlog.sources import files as S
from spanlog.sources import parsers as P


def _lines(spark, xs, with_seq=False):
    if with_seq:
        return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "seq long, value string")
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_listing_lines_and_rejects(spark):
    rows, bad = P.parse_inventory(_lines(spark, ["12345 f ./stuff/notes.txt", "2 d ./.", "garbage"]))
    got = sorted(map(tuple, rows.collect()))
    assert got == [(2, "d", "./", "."), (12345, "f", "./stuff/", "notes.txt")]
    assert [r.value for r in bad.collect()] == ["garbage"]


def test_store_lines_with_open_marker(spark):
    rows, bad = P.parse_version_store(_lines(spark, [
        "12345 f ./stuff/notes.txt/2018-12-24 00:24:00~now",
        "7 f ./a b/c/2018-12-24 00:24:00~2018-12-25 01:00:00",
        "8 f ./x/no-times"]))
    got = {r.inode: r for r in rows.collect()}
    assert got[12345].dirname == "./stuff/" and got[12345].filename == "notes.txt"
    assert got[12345].deleted == dt.datetime.fromisoformat(OPEN_TEXT)
    assert got[7].dirname == "./a b/" and got[7].deleted == dt.datetime(2018, 12, 25, 1, 0)
    assert bad.count() == 1


def test_change_log(spark):
    rows, bad = P.parse_change_log(_lines(spark, [
        "cd+++++++++ dir/", ">f+++++++++ dir/file1.ext", "*deleting   old/file1.ext", "*deleting   old/",
        "<f.st...... other"], with_seq=True))
    assert [(r.op, r.path) for r in rows.orderBy("seq").collect()] == [
        ("new_dir", "dir/"), ("new_file", "dir/file1.ext"), ("del_file", "old/file1.ext"), ("del_dir", "old/")]
    assert bad.count() == 1


def test_run_stats_and_snapshot_dirs_and_commits(spark):
    lines = spark.createDataFrame([("r1", "Number of created files: 12"), ("r1", "Total file size: 5 bytes"),
                                   ("r2", "Number of created files: 3")], "run string, value string")
    got = {r.run: r for r in P.parse_run_stats(lines, ["number_of_created_files", "total_file_size"]).collect()}
    assert got["r1"].number_of_created_files == "12" and got["r1"].total_file_size == "5 bytes"
    assert got["r2"].total_file_size is None
    snaps = spark.createDataFrame([("/b/homes/daily/2018-12-24_00-24-00",), ("/b/apps/daily/2018-12-24_00-24-00",),
                                   ("/b/x/daily/2018-12-25_00-00-00",)], "path string")
    d = sorted(map(tuple, P.parse_snapshot_dirs(snaps).collect()))
    assert d == [(dt.datetime(2018, 12, 24, 0, 24), "/b/apps/daily/2018-12-24_00-24-00"),
                 (dt.datetime(2018, 12, 25), "/b/x/daily/2018-12-25_00-00-00")]
    commits = _lines(spark, ["a 2019-02-03 10:11:12 +0100", "b 2019-02-03 10:11:12 +0100",
                             "c 2019-02-04 10:11:12 +0100", "d 2019-02-03 10:11:12 +0100"], with_seq=True)
    assert [r.hash for r in P.commit_series(commits).orderBy("seq").collect()] == ["a", "c", "d"]


def test_scan_files_reads_no_content(spark):
    df = S.scan_files(spark, SF_SMALL, "*.parquet")
    assert df.count() == 14
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_write_delimited_round_trip(spark, tmp_path):
    from spanlog.plans import fixtures as X
    h = X.hist_events(spark, SF_SMALL)
    back = S.write_delimited(h, str(tmp_path / "out"))
    assert back.count() == h.count()
    assert set(back.columns) == set(h.columns)

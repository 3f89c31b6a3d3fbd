"""Plan checks: pushdown, no Cartesian products, no row-at-a-time Python in batch operators."""

from conftest import SF_SMALL
from spanlog.plans.catalog import QUERIES


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_snapshot_pushes_filters_to_scan(spark, tmp_path):
    from spanlog.operators.travel import snapshot_as_of
    from spanlog.plans import fixtures as X
    path = str(tmp_path / "hist")
    X.hist_events(spark, SF_SMALL).write.parquet(path)
    h = spark.read.parquet(path)
    p = _plan(snapshot_as_of(h, "2024-01-15 00:00:00", "./g1/").select("dirname", "filename"))
    assert "PushedFilters" in p
    assert "StringStartsWith(dirname,./g1/)" in p
    assert "LessThanOrEqual(created" in p and "GreaterThan(deleted" in p
    assert "ReadSchema: struct<type:string,dirname:string,filename:string,created:timestamp,deleted:timestamp>" in p


def test_no_cartesian_or_python_rows(spark):
    skip = {"throttle_stream", "history_stream", "interval_stream", "debounce", "debounce_as_written",
            "busy_coalesce", "write_delimited", "scan_files"}
    for name, q in QUERIES.items():
        if name in skip:
            continue
        p = _plan(q(spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "BatchEvalPython" not in p, name


def test_history_table_prunes_open_partition_and_prefix(spark, tmp_path):
    from spanlog.plans import fixtures as X
    from spanlog.sources.tables import read_history, write_history
    path = str(tmp_path / "h")
    h = X.hist_events(spark, SF_SMALL)
    write_history(h, path)
    o = read_history(spark, path, open_only=True).filter("dirname LIKE './g1/%'")
    p = _plan(o)
    assert "PartitionFilters: [isnotnull(is_open" in p and "(is_open" in p and "StringStartsWith(dirname,./g1/)" in p
    assert o.count() == h.filter("freq = 0 AND dirname LIKE './g1/%'").count()
    assert read_history(spark, path).count() == h.count()


def test_open_partition_is_pruned_by_the_operators(spark, tmp_path):
    from spanlog.operators import checks as H
    from spanlog.operators import history as B
    from spanlog.operators import travel as D
    from spanlog.plans import fixtures as X
    from spanlog.sources.tables import read_history, write_history
    path = str(tmp_path / "h")
    write_history(X.hist_inv(spark, SF_SMALL), path)
    h, inv = read_history(spark, path), X.inv_cur(spark, SF_SMALL)
    for df in (D.live_view(h), B.diff_old(inv, h), B.diff_new(inv, h), H.check_db2current(h, inv)):
        assert "(is_open" in _plan(df) and "PartitionFilters: [isnotnull(is_open" in _plan(df)
    run = B.apply_snapshot(h, inv, "2024-02-01 00:00:00")
    p = _plan(run.history)
    scans = [line for line in p.split("\n") if "PartitionFilters" in line and "is_open" in line]
    assert len(scans) >= 2 and all("isnotnull(is_open" in line for line in scans)  # open and closed apart, never all of it
    assert run.history.count() == B.apply_snapshot(X.hist_inv(spark, SF_SMALL), inv, "2024-02-01 00:00:00").history.count()

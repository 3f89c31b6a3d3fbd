"""The commit log: changes only, old versions, replays, refused and lost writes, pruned reads."""

import pytest
from pyspark.sql import functions as F

from conftest import hist_rows, inv_rows
from spanlog.model import ROW4, empty_history, history_columns, open_versions
from spanlog.operators.history import apply_snapshot, assert_open_unique, diff_new, diff_old, quarantine_conflicts
from spanlog.operators.travel import snapshot_as_of
from spanlog.sources.commits import CommitConflict, CommitTable, split_changes

COLUMNS = ["inode", "type", "dirname", "filename", "created", "deleted", "freq"]


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def listing(spark, day):
    """400 paths, of which one in a hundred changes a day; a few come and go."""
    out = [(1000 + i + (10_000 * day if i % 100 == day else 0), "f", f"./d{i % 7}/", f"n{i}") for i in range(400) if i % 50 != day]
    return inv_rows(spark, out)


def times(day):
    return f"2024-01-{day + 1:02d} 00:00:00"


def step(table, inv, t, batch=None):
    """One listing by B6 against the table's open versions, committed."""
    now = table.open()
    after = apply_snapshot(now, inv, t).history
    return table.commit(*split_changes(now, after), source="test", batch=batch)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    table = CommitTable(spark, str(tmp_path_factory.mktemp("commits")) + "/t")
    table.create(empty_history(spark))
    want, states = empty_history(spark), []
    for day in range(6):
        before = {f["path"] for f in table.version().files}
        v = step(table, listing(spark, day), times(day), batch=day)
        made = apply_snapshot(want, listing(spark, day), times(day)).history
        want = spark.createDataFrame(made.collect(), made.schema)
        states.append((v, want, [f for f in v.files if f["path"] not in before]))
    return table, states


def test_every_version_equals_the_listings_applied_one_by_one(built):
    table, states = built
    for v, want, _ in states:
        assert rows(table.read(v.number)) == rows(want)
    assert rows(table.read()) == rows(states[-1][1])
    assert rows(open_versions(table.read())) == rows(open_versions(states[-1][1]))
    with pytest.raises(ValueError):
        table.read(99)


def test_a_commit_writes_its_changes_only(built):
    _, states = built
    for v, want, added in states[1:]:
        written = sum(f["rows"] for f in added)
        if v.rewritten != v.number:
            assert 0 < written < 0.15 * open_versions(want).count()


def test_a_replayed_batch_commits_nothing(built, spark):
    table, states = built
    v = step(table, listing(spark, 3), times(20), batch=3)
    assert v.number == states[-1][0].number == table.version().number


def test_reads_as_of_a_time_touch_fewer_files_the_younger_it_is(built):
    table, states = built
    for day in (0, 2, 5):
        assert rows(table.as_of(times(day), "./d3/")) == rows(snapshot_as_of(states[-1][1], times(day), "./d3/"))
    files = [len([f for f in table.files_as_of(times(day)) if f["kind"] == "closed"]) for day in range(6)]
    assert files[-1] == 0 and files == sorted(files, reverse=True) and files[0] > 2
    assert not table.files_as_of("2023-12-31 00:00:00") and not table.files_as_of(times(3), "./x/")


def test_two_open_versions_are_refused_and_nothing_is_published(built, spark):
    table, states = built
    again = hist_rows(spark, [(1, 77, "f", "./d1/", "n1", times(9), None)])
    twice = hist_rows(spark, [(1, 77, "f", "./q/", "q", times(9), None), (2, 78, "f", "./q/", "q", times(9), None)])
    for opened in (again, twice):
        with pytest.raises(CommitConflict):
            table.commit(empty_history(spark), opened)
    assert table.version().number == states[-1][0].number and rows(table.read()) == rows(states[-1][1])
    assert assert_open_unique(table.read().drop("is_open")).count() == 0


def test_of_two_writers_one_wins(spark, tmp_path):
    table = CommitTable(spark, f"{tmp_path}/t")
    table.create(hist_rows(spark, [(1, 1, "f", "./a/", "x", times(0), None)]))
    table.create(empty_history(spark))  # exists: nothing happens
    other = CommitTable(spark, f"{tmp_path}/t")
    stale = other.version()
    table.commit(empty_history(spark), hist_rows(spark, [(2, 2, "f", "./a/", "y", times(1), None)]))
    other.version = lambda number=None: stale  # has not seen the other's commit
    with pytest.raises(CommitConflict):
        other.commit(empty_history(spark), hist_rows(spark, [(3, 3, "f", "./a/", "z", times(1), None)]))
    assert sorted(r["filename"] for r in table.read().collect()) == ["x", "y"]


def test_long_logs_are_read_from_their_last_list(spark, tmp_path, monkeypatch):
    from spanlog.sources import commits
    monkeypatch.setattr(commits, "LIST_EVERY", 3)
    table = CommitTable(spark, f"{tmp_path}/t")
    table.create(empty_history(spark))
    for i in range(7):
        table.commit(empty_history(spark), hist_rows(spark, [(i, i, "f", "./a/", f"n{i}", times(i), None)]), "s", i)
    read = []
    monkeypatch.setattr(CommitTable, "_read", lambda self, n, own=CommitTable._read: read.append(n) or own(self, n))
    v = table.version()
    assert read == [6, 7] and v.batches == {"s": 6}
    assert table.read().count() == 7 and table.read(4).count() == 4 and table.read(0).count() == 0


def test_diff_and_quarantine_see_the_same_open_versions(built, spark):
    table, states = built
    inv = listing(spark, 9).unionByName(inv_rows(spark, [(5, "f", "./d1/", "n1")]))
    for h in (table.read(), states[-1][1]):
        new, old = diff_new(inv, h), diff_old(inv, h)
        ins, bad = quarantine_conflicts(new, open_versions(h).join(old.select(*ROW4), ROW4, "left_anti"))
        found = tuple(sorted(map(tuple, x.select(*ROW4).collect())) for x in (new, old, ins, bad))
        first = found if h is not states[-1][1] else first  # noqa: F821
        assert found == first
    assert history_columns(table.read()).filter(F.col("deleted").isNull()).count() == 0

"""Calendar cells: as-of reads against plain filters, cells, files opened as the history grows, repeated additions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanlog.model import HISTORY_SCHEMA, history_columns
from spanlog.operators.travel import list_dir, snapshot_as_of
from spanlog.sources.commits import CommitTable
from spanlog.sources.timecells import NEVER, TimeCells, cell_of, history_as_of

OPEN = datetime(2199, 12, 31)
TIMES = ("2021-12-31 23:59:59", "2022-01-01 00:00:00", "2022-08-03 10:30:00")


def _versions(seed, n, start=datetime(2020, 1, 1), days=1800):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a = start + timedelta(minutes=r.randrange(days * 1440))
        if i % 5 == 0:
            a = a.replace(hour=0, minute=0)
        life = r.choice([timedelta(0), timedelta(minutes=-5), timedelta(minutes=20), timedelta(hours=5), timedelta(days=3), timedelta(days=40), timedelta(days=900), timedelta(hours=1)])
        out.append((i, i, r.choice("ffd"), "./hot/" if i % 3 else f"./d{i % 7}/", f"n{i % 90}", a, a + life, 0))
    return out


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def h(spark):
    odd = [(9000, 1, "f", None, None, datetime(2022, 1, 1), datetime(2023, 1, 1), 0), (9001, 1, "f", "./n/", "x", None, datetime(2023, 1, 1), 0),
           (9002, 1, "f", "./n/", "x", datetime(2022, 1, 1), None, 0)] + [(9003, 1, "f", "./twin/", "x", datetime(2021, 1, 1), datetime(2023, 6, 1), 0)] * 2
    return spark.createDataFrame(_versions(3, 900) + odd, HISTORY_SCHEMA)


def test_reads_equal_the_filtered_history_over_many_additions(spark, h, tmp_path):
    cells = TimeCells(spark, f"{tmp_path}/c")
    for part in range(4):
        cells.add(h.where(F.pmod("row_id", F.lit(4)) == part), part)
        cells.add(h, part)  # a repeated batch changes nothing
    assert len(cells.state()["runs"]) <= 3 and _rows(history_columns(cells.read())) == _rows(history_columns(h))
    for t in TIMES:
        for d in ("./", "./d3/"):
            assert _rows(snapshot_as_of(cells.as_of(t, d), t, d)) == _rows(snapshot_as_of(history_columns(h), t, d))
        assert _rows(list_dir(cells.as_of(t), t).where("dirname is not null")) == _rows(list_dir(h, t).where("dirname is not null"))


def test_a_cell_holds_the_whole_life_and_no_smaller_one_does(spark, h):
    size, cell = cell_of()
    for r in h.select("created", "deleted", size.alias("size"), cell.alias("cell")).collect():
        a, b = r.created, r.deleted
        if a is None or b is None or b <= a:
            assert r.size == NEVER
            continue
        b -= timedelta(microseconds=1)
        floors = [lambda x: x.replace(minute=0, second=0, microsecond=0), lambda x: x.date(), lambda x: x.date() - timedelta(days=x.weekday())]
        months = [x.year * 12 + x.month - 1 for x in (a, b)]
        holds = [f(a) == f(b) for f in floors] + [months[0] >> n == months[1] >> n for n in range(18)]
        assert r.size == holds.index(True)
        if r.size > 2:
            assert r.cell == months[0] >> (r.size - 3)


def test_the_share_of_files_opened_shrinks_as_the_history_grows(spark, tmp_path):
    """Ten versions per day and a file per some versions: eight times the history, an equal number of files opened."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        opened, files = [], []
        for years in (1, 8):
            rows = [(i, i, "f", "./a/", f"n{i}", datetime(2016, 1, 1) + timedelta(hours=2 * i), datetime(2016, 1, 1) + timedelta(hours=2 * i + 30), 0)
                    for i in range(4380 * years)]
            spark.conf.set("spark.sql.shuffle.partitions", str(16 * years))
            cells = TimeCells(spark, f"{tmp_path}/y{years}")
            cells.add(spark.createDataFrame(rows, HISTORY_SCHEMA))
            t = "2016-06-15 12:00:00"
            found = cells.files_as_of(t)
            opened.append(len(found))
            files.append(cells._files(cells.state()["runs"]).count())
            assert cells.as_of(t).count() == 15
        assert files[1] > 4 * files[0] and opened[1] <= opened[0] + 2 and opened[1] < files[1] / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_cells_follow_a_commit_log(spark, tmp_path):
    table, cells = CommitTable(spark, f"{tmp_path}/t"), TimeCells(spark, f"{tmp_path}/c")
    begun = [(i, i, "f", "./a/", f"n{i}", datetime(2024, 1, 1 + i), OPEN, 0) for i in range(12)]
    table.create(spark.createDataFrame(begun, HISTORY_SCHEMA))
    none = spark.createDataFrame([], HISTORY_SCHEMA)
    for step in range(3):
        ended = [(*r[:6], datetime(2024, 2, 1 + step), 0) for r in begun[step * 2:step * 2 + 2]]
        table.commit(spark.createDataFrame(ended, HISTORY_SCHEMA), none)
        if step < 2:
            cells.catch_up(table)
    # the last commit is not in the cells yet
    for t in ("2024-01-03 00:00:00", "2024-01-31 00:00:00", "2024-02-02 00:00:00", "2024-03-01 00:00:00"):
        want = _rows(history_columns(table.as_of(t)))
        assert _rows(history_as_of(table, cells, t)) == want
        assert cells.state()["upto"] == 2
    cells.catch_up(table)
    assert _rows(history_as_of(table, cells, "2024-01-31 00:00:00")) == _rows(history_columns(table.as_of("2024-01-31 00:00:00")))


def test_an_empty_index(spark, tmp_path):
    cells = TimeCells(spark, f"{tmp_path}/c")
    assert cells.as_of(TIMES[0]).count() == 0 and cells.read().count() == 0
    cells.add(spark.createDataFrame([], HISTORY_SCHEMA), 0)
    assert cells.as_of(TIMES[0]).count() == 0 and cells.files_as_of(TIMES[0]) == []

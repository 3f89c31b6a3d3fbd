"""Closed versions by the calendar cell that holds their whole life: reads as of a time open a few cells.

Sorted by path, every file holds versions of all times and none can be passed over for a time. Here a version lies in the smallest
cell that contains it: an hour, a day, a week, or 2^n months. At a time *t* one cell of each size contains *t*, and no other cell can
hold a version valid at *t*, so a read opens the files of about twenty cells however long the history is. A version that spans
a cell's border lies in a larger cell; cells of 2^n months are those of a binary tree over the months, so long lives spread over
the tree and do not pile up in one cell.

Files are immutable and sorted by (size, cell, path). Every addition writes one *run* of files; while the newest run holds at least
half the rows of the one before, both are merged, so there are at most log2(rows) runs and a row is rewritten at most that often. A
manifest names the runs; each run carries a table of its files' ranges, which is filtered by Spark: the driver gets the names
of the files to open, nothing else.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import floor_to
from ..model import HISTORY_SCHEMA, history_columns, ts
from .commits import CommitTable, ManifestLog

#: Sizes below the months, smallest first; 2^n months have the size ``len(SMALL) + n``.
SMALL = ("hour", "day", "week")
#: Versions that are valid at no time (they end before or when they start, or lack an end) lie in no cell.
NEVER = -1
#: Months are counted from the year 0; 2^17 of them reach beyond the year 9999.
MONTH_BITS = 17
COLUMNS = [f.name for f in HISTORY_SCHEMA.fields]
STORED = "size int, cell long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HISTORY_SCHEMA.fields)


def _month(t: Column) -> Column:
    return F.year(t).cast("long") * 12 + F.month(t) - 1


def cell_of(created="created", deleted="deleted") -> tuple[Column, Column]:
    """(size, cell) of the smallest cell that contains [created, deleted)."""
    first, last = F.col(created), F.col(deleted) - F.expr("INTERVAL 1 MICROSECOND")
    # the place of the highest bit in which the two months differ, from 1: 0 for one month
    bits = F.when(_month(first) == _month(last), 0).otherwise(F.length(F.bin(_month(first).bitwiseXOR(_month(last)))))
    size, cell = F.when(~F.coalesce(first <= last, F.lit(False)), NEVER), F.when(~F.coalesce(first <= last, F.lit(False)), F.lit(0).cast("long"))
    for i, grain in enumerate(SMALL):
        same = floor_to(grain, first) == floor_to(grain, last)
        size, cell = size.when(same, i), cell.when(same, F.unix_timestamp(floor_to(grain, first)))
    return size.otherwise(len(SMALL) + bits).cast("int"), cell.otherwise(F.call_function("shiftright", _month(first), bits)).cast("long")


class TimeCells(ManifestLog):
    """The closed versions of a history, added as they end."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path)

    def state(self) -> dict:
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else {"version": -1, "runs": [], "upto": -1}

    # writing

    def _run(self, rows: DataFrame) -> dict | None:
        """Writes rows with their cells as one run and the table of its files; no rows, no run."""
        folder = f"data/{uuid.uuid4().hex}"
        order = ["size", "cell", "dirname", "filename", "created"]
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(STORED).parquet(f"{self.path}/{folder}")
        place = F.struct("size", "cell")
        ranges = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(
            F.min(place).alias("low"), F.max(place).alias("high"), F.min("dirname").alias("low_dirname"),
            F.max("dirname").alias("high_dirname"), F.count("*").alias("rows"))
        ranges.write.parquet(f"{self.path}/{folder}-files")
        n = self._files([{"folder": folder}]).agg(F.sum("rows")).head()[0]
        return {"folder": folder, "rows": n} if n else None

    def _files(self, runs: list[dict]) -> DataFrame:
        kind = "name string, low struct<size:int,cell:long>, high struct<size:int,cell:long>, low_dirname string, high_dirname string, rows long"
        parts = [self.spark.read.schema(kind).parquet(f"{self.path}/{r['folder']}-files").select(F.lit(r["folder"]).alias("folder"), "*") for r in runs]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"folder string, {kind}")

    def _scan(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(*[f"{self.path}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], STORED)

    def add(self, closed: DataFrame, upto: int | None = None) -> None:
        """Adds versions that have ended. With ``upto``, a number that only grows, a repeated addition changes nothing."""
        now = self.state()
        if upto is not None and upto <= now["upto"]:
            return
        size, cell = cell_of()
        run = self._run(history_columns(closed).select(size.alias("size"), cell.alias("cell"), *COLUMNS))
        runs = now["runs"] + ([run] if run else [])
        while len(runs) > 1 and 2 * runs[-1]["rows"] >= runs[-2]["rows"]:
            runs = runs[:-2] + [self._run(self._scan([r["folder"] for r in runs[-2:]]))]
        self._publish({"version": now["version"] + 1, "runs": runs, "upto": now["upto"] if upto is None else upto})

    def catch_up(self, table: CommitTable) -> None:
        """Adds what has ended in a commit log since the last time."""
        v, upto = table.version(), self.state()["upto"]
        if v.number > upto:
            self.add(table._scan([f for f in v.files if f["version"] > upto], "closed"), v.number)

    # reading

    def cells_at(self, t: str) -> list[tuple[int, int]]:
        """The cells that contain ``t`` ('yyyy-MM-dd HH:mm:ss'), one per size."""
        small = [F.unix_timestamp(floor_to(g, ts(t))) for g in SMALL]
        cells = list(self.spark.range(1).select(*small).head())
        at = datetime.fromisoformat(t)
        month = at.year * 12 + at.month - 1
        return list(enumerate(cells + [month >> n for n in range(MONTH_BITS + 1)]))

    def files_as_of(self, t: str, directory: str = "./") -> list[str]:
        """The files that can hold a version under ``directory`` valid at ``t``."""
        def place(size, cell):
            return F.struct(F.lit(size).cast("int").alias("size"), F.lit(cell).cast("long").alias("cell"))
        holds = reduce(Column.__or__, [(F.col("low") <= place(*c)) & (F.col("high") >= place(*c)) for c in self.cells_at(t)])
        beside = (F.col("high_dirname") < directory) | (F.substring("low_dirname", 1, len(directory)) > directory)
        found = self._files(self.state()["runs"]).where(holds & ~F.coalesce(beside, F.lit(True)))
        return [f"{r['folder']}/{r['name']}" for r in found.select("folder", "name").collect()]

    def as_of(self, t: str, directory: str = "./") -> DataFrame:
        """The closed versions under ``directory`` that are valid at ``t``; of the opened files, other cells' row groups are not read."""
        at = reduce(Column.__or__, [(F.col("size") == s) & (F.col("cell") == c) for s, c in self.cells_at(t)])
        valid = F.col("dirname").startswith(directory) & (F.col("created") <= ts(t)) & (F.col("deleted") > ts(t))
        return self._scan(self.files_as_of(t, directory)).where(at & valid).select(*COLUMNS)

    def read(self) -> DataFrame:
        """Every closed version, with its cell."""
        return self._scan([r["folder"] for r in self.state()["runs"]])


def history_as_of(table: CommitTable, cells: TimeCells, t: str, directory: str = "./") -> DataFrame:
    """D1, D2, D14's input: what a commit log holds under ``directory`` at ``t``. Closed versions come from their cells (and those not yet
    caught up from the log's files), open ones from the log."""
    v, upto = table.version(), cells.state()["upto"]
    valid = F.col("dirname").startswith(directory) & (F.col("created") <= ts(t)) & (F.col("deleted") > ts(t))
    files = table.files_as_of(t, directory)
    rest = table._scan([f for f in files if f["version"] > upto], "closed").unionByName(table._open(v, files)).where(valid)
    return cells.as_of(t, directory).unionByName(rest.select(*COLUMNS))

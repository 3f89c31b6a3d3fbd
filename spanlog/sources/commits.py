"""A history table as a commit log over append-only files.

``data/`` holds immutable Parquet files, ``log/`` one manifest per version. A manifest names the files that its version adds, with
their kind (``open`` or ``closed`` versions), rows and the ranges of path and time in them, and whether it replaces all open files.
A manifest becomes visible by a rename that fails if the version exists, so of two writers one wins and the other publishes
nothing; files that no manifest names are never read.

A commit writes what changed and nothing else: versions that ended (``closed``) and versions that began (``open``). A version that
ended still lies in an older open file; reading leaves it out by the closed files committed since the open files were last
rewritten. They are rewritten (one commit of kind ``rewrite``) when the rows so written exceed ``REWRITE_SHARE`` of the open rows, so
the work per commit stays in proportion to its changes. Closed files are never rewritten: all rows of one ended in the same commit,
so a read as of a time passes over every closed file committed before it, and over files whose first version is younger.

The driver reads manifests, not rows: a list of file names, of which every ``LIST_EVERY`` versions a manifest carries the whole.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import HISTORY_SCHEMA, KEY, VERSION, history_columns, is_open, open_ts, ts

REWRITE_SHARE = 0.5
LIST_EVERY = 20
#: What tells a version from all others whether it is open or has ended since.
IDENTITY = [c for c in VERSION if c != "deleted"]


class CommitConflict(RuntimeError):
    """Another writer published this version first, or the rows would leave a path with two open versions."""


def _without(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The versions among ``rows`` that are not among ``others``, open or ended. Which side is sent is left to the optimizer."""
    keys = others.select(*[F.col(c).alias(f"_{c}") for c in IDENTITY])
    return rows.join(keys, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in IDENTITY]), "left_anti")


class ManifestLog:
    """Numbered manifests under ``log/`` of a table's folder; of two writers of one number the second fails."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        log = self._at(f"{self.path}/log")
        if not self._fs().exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(log)]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit())

    def _read(self, number: int) -> dict:
        stream = self._fs().open(self._at(f"{self.path}/log/{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        jvm = self._jvm.org.apache.hadoop.fs
        draft = f"{self.path}/log/_{uuid.uuid4().hex}"
        out = self._fs().create(self._at(draft), False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = self._at(f"{self.path}/log/{manifest['version']:012d}.json")
        context = jvm.FileContext.getFileContext(self._at(self.path).toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
        try:
            context.rename(self._at(draft), target, options)  # without the option to overwrite
        except Exception as e:
            self._fs().delete(self._at(draft), False)
            raise CommitConflict(f"version {manifest['version']} exists") from e


@dataclass
class Version:
    """The files that make up a version of the table."""
    number: int = -1
    files: list[dict] = field(default_factory=list)  # path, kind, version, rows, low and high of path, created and deleted
    rewritten: int = -1  # the version that last wrote all open rows
    batches: dict[str, int] = field(default_factory=dict)  # per source the last batch that is in the table

    def after(self, manifest: dict) -> Version:
        files = manifest["list"] if manifest.get("list") is not None else [
            f for f in self.files if not (manifest["rewrite"] and f["kind"] == "open")] + manifest["add"]
        return Version(manifest["version"], files, manifest["version"] if manifest["rewrite"] else manifest.get("rewritten", self.rewritten),
                       {**self.batches, **manifest["batches"]})


class CommitTable(ManifestLog):
    def version(self, number: int | None = None) -> Version:
        """The table's newest version, or an older one: from the last whole list up to it."""
        numbers = [n for n in self._numbers() if number is None or n <= number]
        if number is not None and (not numbers or numbers[-1] != number):
            raise ValueError(f"no version {number}")
        out = Version()
        for n in numbers[len(numbers) and (numbers[-1] // LIST_EVERY) * LIST_EVERY:]:
            out = out.after(self._read(n))
        return out

    # reading

    def _scan(self, files: list[dict], kind: str) -> DataFrame:
        own = [f"{self.path}/{f['path']}" for f in files if f["kind"] == kind]
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(*own) if own else self.spark.createDataFrame([], HISTORY_SCHEMA)

    def _open(self, v: Version, files: list[dict]) -> DataFrame:
        """Open versions: rows of open files that no closed file since their rewriting ends."""
        ended = [f for f in v.files if f["kind"] == "closed" and f["version"] > v.rewritten]
        rows = self._scan(files, "open")
        if not ended:
            return rows
        return _without(rows, self._scan(ended, "closed"))

    def read(self, number: int | None = None) -> DataFrame:
        """All versions of paths in the table's newest or a given version, with ``is_open`` (readers of open ones skip the closed files)."""
        v = self.version(number)
        closed = self._scan(v.files, "closed").withColumn("is_open", F.lit(0))
        return closed.unionByName(self._open(v, v.files).withColumn("is_open", F.lit(1)))

    def open(self, number: int | None = None) -> DataFrame:
        v = self.version(number)
        return self._open(v, v.files)

    def files_as_of(self, t: str, directory: str = "./", number: int | None = None) -> list[dict]:
        """The files that can hold a version under ``directory`` that is valid at ``t`` ('yyyy-MM-dd HH:mm:ss')."""
        return [f for f in self.version(number).files
                if (f["low_created"] or "") <= t < (f["high_deleted"] or "") and (f["high_dirname"] or "") >= directory
                and (f["low_dirname"] or "")[:len(directory)] <= directory]

    def as_of(self, t: str, directory: str = "./", number: int | None = None) -> DataFrame:
        """D1 on the pruned files: the versions under ``directory`` that are valid at ``t``."""
        v, files = self.version(number), self.files_as_of(t, directory, number)
        valid = F.col("dirname").startswith(directory) & (F.col("created") <= ts(t)) & (F.col("deleted") > ts(t))
        # a version that ended after t comes from its closed file, so an open file's copy of it is left out as in any read
        return self._scan(files, "closed").where(valid).unionByName(self._open(v, files).where(valid))

    # writing

    def _write(self, rows: DataFrame, kind: str, number: int) -> list[dict]:
        """Writes rows as new files, by path; returns their entries. No rows, no files."""
        folder = f"data/{number:012d}-{kind}-{uuid.uuid4().hex}"
        (history_columns(rows).repartitionByRange("dirname", "filename", "created").sortWithinPartitions("dirname", "filename", "created")
         .write.parquet(f"{self.path}/{folder}"))
        written = self.spark.read.schema(HISTORY_SCHEMA).parquet(f"{self.path}/{folder}")

        def text(c: Column) -> Column:
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        stats = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(
            F.count("*").alias("rows"), F.min("dirname").alias("low_dirname"), F.max("dirname").alias("high_dirname"),
            text(F.min("created")).alias("low_created"), text(F.max("deleted")).alias("high_deleted"))
        return [{"path": f"{folder}/{r['name']}", "kind": kind, "version": number} | {k: v for k, v in r.asDict().items() if k != "name"}
                for r in stats.orderBy("name").collect()]  # one row per file

    def create(self, start: DataFrame) -> None:
        """Version 0 from a whole history; does nothing if the table exists."""
        if self._numbers():
            return
        closed = ~F.coalesce(is_open("deleted"), F.lit(False))
        add = self._write(start.where(closed), "closed", 0) + self._write(self._unique(start.where(~closed)), "open", 0)
        self._publish({"version": 0, "add": add, "list": add, "rewrite": True, "batches": {}})

    def _unique(self, opened: DataFrame, still: DataFrame | None = None) -> DataFrame:
        """``opened``, whose writing fails if a path has two open versions among them and ``still``. The rows grouped are the opened
        paths' alone; the other open versions are looked up."""
        counts = opened.groupBy(*KEY).agg(F.count("*").alias("_n"))
        if still is not None:
            counts = counts.join(still.select(*KEY, F.lit(1).alias("_held")), KEY, "left")
        clash = (F.col("_n") > 1) | (F.col("_held").isNotNull() if still is not None else F.lit(False))
        bad = counts.where(clash).select(*[F.col(c).alias(f"_{c}") for c in KEY], F.lit(True).alias("_bad"))
        on = F.col("dirname").eqNullSafe(F.col("_dirname")) & F.col("filename").eqNullSafe(F.col("_filename"))
        refused = F.raise_error(F.concat(F.lit("two open versions of "), "dirname", "filename"))
        checked = F.when(F.col("_bad"), refused.cast("long")).otherwise(F.col("row_id"))
        return history_columns(opened.join(bad, on, "left").withColumn("row_id", checked))

    def commit(self, closed: DataFrame, opened: DataFrame, source: str = "", batch: int | None = None) -> Version:
        """Publishes a version in which the open versions ``closed`` (with their end) have ended and ``opened`` have begun.

        A batch of a source that is already in the table changes nothing. A path left with two open versions (B10) fails the write,
        a version published meanwhile by another writer the rename; either way nothing is published."""
        v = self.version()
        if batch is not None and v.batches.get(source, -1) >= batch:
            return v
        number = v.number + 1
        ended = self._write(closed, "closed", number)
        still = _without(self._open(v, v.files), self._scan(ended, "closed"))
        try:
            began = self._write(self._unique(opened, still), "open", number)
        except Exception as e:
            if "two open versions" in str(e):
                raise CommitConflict("a path would have two open versions; nothing was published") from e
            raise
        add = ended + began
        manifest = {"version": number, "add": add, "rewrite": False, "batches": {source: batch} if batch is not None else {}}
        after = v.after(manifest)
        changed = sum(f["rows"] for f in after.files if f["version"] > v.rewritten)
        first = sum(f["rows"] for f in after.files if f["kind"] == "open" and f["version"] <= v.rewritten)
        if changed > REWRITE_SHARE * max(1, first):
            manifest = manifest | {"add": ended + self._write(self._open(after, after.files), "open", number), "rewrite": True}
            after = v.after(manifest)
        if number % LIST_EVERY == 0:
            manifest = manifest | {"list": after.files, "rewritten": after.rewritten, "batches": after.batches}
        self._publish(manifest)
        return after


def split_changes(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed, opened) between the open versions ``before`` and the versions ``after`` that stand for them now: what ended, and
    what is open and was not before."""
    closed = after.where(F.col("deleted") != open_ts())
    return closed, _without(after.where(F.col("deleted") == open_ts()), before)

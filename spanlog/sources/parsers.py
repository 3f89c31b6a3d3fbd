"""Parsers of the text inputs: listings, version-store names, change logs, run logs,
snapshot directory names and commit lists.

Each takes a DataFrame of lines (column ``value``, as ``spark.read.text`` gives)
and returns a DataFrame; lines that do not match go to a reject DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import NOW_WORD, open_ts
from ..plans.ordered import keyed_scan
from .render import OP_DELETING, OP_NEW_DIR, OP_NEW_FILE, TIME_SEP

# Line patterns.
LISTING_RE = r"^([0-9]+) (.) (.*/)([^/]*)$"
STORE_RE = r"^([0-9]+) (.) (.*/)([^/]*)/([^/{sep}]*){sep}([^/{sep}]*)$"
STATS_RE = r"^([^:]*): (.*)$"
SNAPDIR_RE = r"([0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{2}-[0-9]{2}-[0-9]{2})$"
COMMIT_RE = r"^(\S+) (\S+ \S+) (\S+)$"
TIME_IN_NAMES = "yyyy-MM-dd HH:mm:ss"


def _split(df: DataFrame, ok) -> tuple[DataFrame, DataFrame]:
    return df.filter(ok), df.filter(~ok)


def parse_inventory(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1: ``inode type dir/name`` -> (inode, type, dirname, filename); the root ``./.``
    gives (``./``, ``.``).  Returns (rows, rejects)."""
    v = F.col("value")
    ok = v.rlike(LISTING_RE)
    good, bad = _split(lines, ok)
    rows = good.select(
        F.regexp_extract(v, LISTING_RE, 1).cast("long").alias("inode"),
        F.regexp_extract(v, LISTING_RE, 2).alias("type"),
        F.regexp_extract(v, LISTING_RE, 3).alias("dirname"),
        F.regexp_extract(v, LISTING_RE, 4).alias("filename"))
    return rows, bad


def parse_version_store(lines: DataFrame, sep: str = TIME_SEP, now: str = NOW_WORD,
                        time_format: str = TIME_IN_NAMES) -> tuple[DataFrame, DataFrame]:
    """A3: ``inode type dir/file/created~deleted`` -> history rows; ``now`` becomes open."""
    pat = STORE_RE.format(sep=sep)
    v = F.col("value")
    good, bad = _split(lines, v.rlike(pat))

    def g(i):
        return F.regexp_extract(v, pat, i)

    deleted = F.when(g(6) == now, open_ts()).otherwise(F.to_timestamp(g(6), time_format))
    rows = good.select(g(1).cast("long").alias("inode"), g(2).alias("type"), g(3).alias("dirname"),
                       g(4).alias("filename"), F.to_timestamp(g(5), time_format).alias("created"),
                       deleted.alias("deleted"))
    return rows, bad


def parse_change_log(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A5: itemized sync lines (``seq``, ``value``) -> (seq, op, path).

    The first 12 characters are the operation; the rest, stripped, the path.
    Deleting a name ending in '/' deletes a directory.
    """
    code = F.substring("value", 1, 12)
    path = F.trim(F.expr("substring(value, 13)"))
    op = (F.when(code == OP_NEW_DIR, F.lit("new_dir"))
          .when(code == OP_NEW_FILE, F.lit("new_file"))
          .when((code == OP_DELETING) & path.endswith("/"), F.lit("del_dir"))
          .when(code == OP_DELETING, F.lit("del_file")))
    x = lines.select("seq", op.alias("op"), path.alias("path"), "value")
    good, bad = _split(x, F.col("op").isNotNull())
    return good.drop("value"), bad.select("seq", "value")


def metric_name(name):
    return F.regexp_replace(F.lower(F.trim(name)), r"[^a-z0-9]+", "_")


def parse_run_stats(lines: DataFrame, metrics: list[str]) -> DataFrame:
    """``name: value`` lines of each run (``run``, ``value``) -> one wide row per run.

    The metric list is given (the pivot then needs no extra pass to find it); metrics outside
    the list are in ``parse_run_metrics``. Of a metric stated twice in a run the greatest text counts.
    """
    return parse_run_metrics(lines).groupBy("run").pivot("metric", metrics).agg(F.max("val"))


def parse_run_metrics(lines: DataFrame) -> DataFrame:
    """A6, long form: (run, metric, val) of every ``name: value`` line."""
    v = F.col("value")
    return lines.filter(v.rlike(STATS_RE)).select(
        "run", metric_name(F.regexp_extract(v, STATS_RE, 1)).alias("metric"),
        F.trim(F.regexp_extract(v, STATS_RE, 2)).alias("val"))


def parse_snapshot_dirs(paths: DataFrame, col: str = "path") -> DataFrame:
    """``…/YYYY-MM-DD_HH-MM-SS`` -> time; one directory per time (first by path)."""
    t = F.to_timestamp(F.regexp_extract(col, SNAPDIR_RE, 1), "yyyy-MM-dd_HH-mm-ss")
    x = paths.select(t.alias("t"), F.col(col).alias("path")).filter(F.col("t").isNotNull())
    return x.groupBy("t").agg(F.min("path").alias("path"))


def commit_series(lines: DataFrame) -> DataFrame:
    """``hash date time tz`` lines (``seq``, ``value``) -> commits whose time differs
    from the previous line's time (consecutive duplicates dropped).

    Lines are ordered by (seq, text); only identical lines tie.  The previous
    line is found by a range-partitioned scan over that global order, not by a
    window over one partition.
    """
    v = F.col("value")
    c = lines.select("seq", "value", F.regexp_extract(v, COMMIT_RE, 1).alias("hash"),
                     F.to_timestamp(F.regexp_extract(v, COMMIT_RE, 2), "yyyy-MM-dd HH:mm:ss").alias("t"),
                     F.regexp_extract(v, COMMIT_RE, 3).alias("tz"))
    s = keyed_scan(c, [], ["seq", "value"], lag=["t"])
    keep = F.col("lag_t").isNull() | (F.col("lag_t") != F.col("t"))
    return s.filter(keep).drop("lag_t", "value")

"""Registered queries over the commit log (B4-B6 kept as changes, D1 on pruned files)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classes import freq_class
from ..model import KEY, history_columns, open_ts, ts
from ..session import scratch_path
from ..sources.commits import CommitTable
from . import fixtures as X
from .registry import register

#: The event history is committed as it grew: up to each of these times in turn, then to its end.
COMMITS = ("2024-01-10 00:00:00", "2024-01-15 00:00:00", "2024-01-20 00:00:00", None)
AT = "2024-01-17 00:00:00"


def grown(spark, sf) -> CommitTable:
    """The event history as a commit log: a start and three commits of what ended and began between two times."""
    h = history_columns(X.hist_events(spark, sf))
    table = CommitTable(spark, scratch_path(spark, "commits"))
    before = None
    for t in COMMITS:
        known = F.lit(True) if t is None else F.col("created") <= ts(t)
        over = (F.col("deleted") < open_ts()) if t is None else (F.col("deleted") <= ts(t))
        so_far = h.where(known)
        still = so_far.where(~over).withColumn("deleted", open_ts()).withColumn("freq", freq_class("created", "deleted"))
        if before is None:
            table.create(so_far.where(over).unionByName(still))
        else:
            since = ts(before)
            table.commit(so_far.where(over & (F.col("deleted") > since)), still.where(F.col("created") > since))
        before = t
    return table


@register("commit_log", "SELECT row_id, inode, type, dirname, filename, created, deleted, freq FROM hist_events", ("hist_events",))
def q_commit_log(spark, sf):
    """B4-B6 as commits: the newest version of the log holds the whole history."""
    return grown(spark, sf).read()


@register("commit_log_version", f"""
SELECT row_id, inode, type, dirname, filename, created,
       CASE WHEN deleted <= TIMESTAMP '{COMMITS[1]}' THEN deleted ELSE TIMESTAMP '2199-12-31' END AS deleted
FROM hist_events WHERE created <= TIMESTAMP '{COMMITS[1]}'""", ("hist_events",))
def q_commit_log_version(spark, sf):
    """An older version of the log (the second of four) stays readable: the history as it was known then."""
    return grown(spark, sf).read(1).drop("freq")


@register("commit_log_as_of", f"""
SELECT row_id, inode, type, dirname, filename, created, deleted FROM hist_events
WHERE starts_with(dirname, './g3/') AND created <= TIMESTAMP '{AT}' AND deleted > TIMESTAMP '{AT}'""", ("hist_events",))
def q_commit_log_as_of(spark, sf):
    """D1 on the log: files that ended before the time, began after it or lie beside the directory are not read."""
    return grown(spark, sf).as_of(AT, "./g3/").drop("freq")


@register("commit_log_files", f"""
SELECT count(*) AS n_open, count(DISTINCT dirname || '/' || filename) AS n_paths FROM hist_events WHERE deleted = TIMESTAMP '2199-12-31'""",
          ("hist_events",))
def q_commit_log_files(spark, sf):
    """B10 held by the write path: as many open versions as paths with one."""
    return grown(spark, sf).open().agg(F.count("*").alias("n_open"), F.countDistinct(*KEY).alias("n_paths"))

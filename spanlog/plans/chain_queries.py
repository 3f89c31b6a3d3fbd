"""Registered queries over chained rolling snapshots (D7 stored as changes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import open_ts, ts
from ..session import scratch_path
from ..sources.chain import SnapshotChain
from . import fixtures as X
from .registry import register

START, MIDDLE, END = "2024-01-01 00:00:00", "2024-01-16 00:00:00", "2024-01-31 00:00:00"
AT = "2024-01-23 00:00:00"
DAYS = f"(SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 DAY)) AS b) g"


def january(spark, sf) -> SnapshotChain:
    """Daily snapshots of the event history, made in two goes: as the history was known in the middle of the month, and at its end."""
    h = X.hist_events(spark, sf)
    chain = SnapshotChain(spark, scratch_path(spark, "chain"), "day")
    then = h.where(F.col("created") <= ts(MIDDLE)).withColumn("deleted", F.when(F.col("deleted") <= ts(MIDDLE), F.col("deleted")).otherwise(open_ts()))
    chain.extend(then, MIDDLE, start=START)
    chain.extend(h, END)
    return chain


@register("snapshot_chain", f"""
SELECT strftime(b, '%Y-%m-%d') AS bucket, b AS boundary, dirname, filename, inode, created
FROM hist_events h JOIN {DAYS} ON h.created <= g.b AND g.b < h.deleted
WHERE h.type <> 'd'""", ("hist_events",))
def q_snapshot_chain(spark, sf):
    """D7 from the chain: the rows of every daily snapshot."""
    return january(spark, sf).all_snapshots()


@register("snapshot_chain_at", f"""
SELECT dirname, filename, inode, created FROM hist_events
WHERE type <> 'd' AND created <= TIMESTAMP '{AT}' AND deleted > TIMESTAMP '{AT}'""", ("hist_events",))
def q_snapshot_chain_at(spark, sf):
    """D7, one bucket: a base and the changes after it."""
    return january(spark, sf).snapshot(AT)


@register("snapshot_chain_changes", f"""
WITH s AS (SELECT min(b) AS low, max(b) AS high FROM (SELECT h.rowid AS id, b FROM (SELECT *, row_number() OVER () AS rowid FROM hist_events WHERE type <> 'd') h
           JOIN {DAYS} ON h.created <= g.b AND g.b < h.deleted) GROUP BY id),
c AS (SELECT low AS boundary, 1 AS a, 0 AS r FROM s UNION ALL
      SELECT high + INTERVAL 1 DAY, 0, 1 FROM s WHERE high < TIMESTAMP '{END}')
SELECT boundary, CAST(sum(a) AS BIGINT) AS added, CAST(sum(r) AS BIGINT) AS removed FROM c GROUP BY boundary""", ("hist_events",))
def q_snapshot_chain_changes(spark, sf):
    """D7, what is stored per boundary: versions added and removed since the one before."""
    chain = january(spark, sf)
    none = F.lit(0).cast("long")
    both = chain.rows("adds").select("boundary", F.col("copies").alias("a"), none.alias("r")).unionByName(
        chain.rows("removes").select("boundary", none.alias("a"), F.col("copies").alias("r")))
    return both.groupBy("boundary").agg(F.sum("a").alias("added"), F.sum("r").alias("removed"))

"""Registered queries over calendar cells (D1 and D2 on files found by time)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.travel import list_dir, snapshot_as_of
from ..session import scratch_path
from ..sources.timecells import TimeCells, history_as_of
from . import fixtures as X
from .commit_queries import AT, grown
from .registry import register

VISIBLE = f"created <= TIMESTAMP '{AT}' AND deleted > TIMESTAMP '{AT}'"


def _known(spark, sf, directory: str = "./"):
    """The event history as a commit log, whose ended versions lie in calendar cells, as of a time."""
    table = grown(spark, sf)
    cells = TimeCells(spark, scratch_path(spark, "cells"))
    cells.catch_up(table)
    return history_as_of(table, cells, AT, directory)


@register("cells_as_of", f"""
SELECT row_id, inode, type, dirname, filename, created, deleted, freq FROM hist_events
WHERE starts_with(dirname, './g3/') AND type <> 'd' AND {VISIBLE}""", ("hist_events",))
def q_cells_as_of(spark, sf):
    """D1 from the cells that contain the time."""
    return snapshot_as_of(_known(spark, sf, "./g3/"), AT, "./g3/")


@register("cells_list_dir", f"""
SELECT dirname, filename, type, created, deleted FROM hist_events WHERE filename <> '.' AND {VISIBLE}""", ("hist_events",))
def q_cells_list_dir(spark, sf):
    """D2, every directory, from the cells that contain the time."""
    return list_dir(_known(spark, sf), AT)


@register("cells_stored", """
WITH c AS (SELECT created AS a, deleted - INTERVAL 1 MICROSECOND AS b, extract(year FROM created) * 12 + extract(month FROM created) - 1 AS m,
                  extract(year FROM deleted - INTERVAL 1 MICROSECOND) * 12 + extract(month FROM deleted - INTERVAL 1 MICROSECOND) - 1 AS n
           FROM hist_events WHERE deleted < TIMESTAMP '2199-12-31'),
l AS (SELECT CASE WHEN a > b THEN -1 WHEN date_trunc('hour', a) = date_trunc('hour', b) THEN 0 WHEN date_trunc('day', a) = date_trunc('day', b) THEN 1
                  WHEN date_trunc('week', a) = date_trunc('week', b) THEN 2
                  ELSE 3 + (SELECT min(k) FROM range(18) r(k) WHERE m >> k::BIGINT = n >> k::BIGINT) END AS size FROM c)
SELECT CAST(size AS INTEGER) AS size, count(*) AS versions FROM l GROUP BY size""", ("hist_events",))
def q_cells_stored(spark, sf):
    """How many ended versions lie in cells of each size."""
    cells = TimeCells(spark, scratch_path(spark, "cells"))
    cells.catch_up(grown(spark, sf))
    return cells.read().groupBy("size").agg(F.count("*").alias("versions"))

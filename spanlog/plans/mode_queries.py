"""Modes of operators whose main form is registered elsewhere: other grains, orders, windows, guards and parser rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup as G
from ..operators import protect as K
from ..operators import retention as Fr
from ..operators import travel as D
from ..session import scratch_path
from ..sources import files as S
from ..sources import parsers as P
from ..sources import render as W
from . import fixtures as X
from .fixtures import NOW_ORDERS
from .registry import register
from .source_queries import ELIG_SQL
from .travel_queries import OLDEST_SQL
from .upkeep_queries import HC

HOURS_SQL = """
SELECT strftime(b, '%Y-%m-%d %H') AS bucket, b AS boundary, dirname, filename, inode, created, deleted
FROM hist_events h
JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-02', INTERVAL 1 HOUR)) AS b) g
  ON h.created <= g.b AND g.b < h.deleted
WHERE h.type <> 'd'"""
MONTHS_SQL = """
SELECT strftime(b, '%Y-%m') AS bucket, b AS boundary, dirname, filename, inode, created, deleted
FROM hist_orders h
JOIN (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1996-12-01', INTERVAL 1 MONTH)) AS b) g
  ON h.created <= g.b AND g.b < h.deleted
WHERE h.type <> 'd'"""


def _hours(spark, sf):
    return D.rolling_snapshots(X.hist_events(spark, sf), "hour", "2024-01-01 00:00:00", "2024-01-02 00:00:00")


def _months(spark, sf):
    return D.rolling_snapshots(X.hist_orders(spark, sf), "month", "1996-01-01 00:00:00", "1996-12-01 00:00:00")


@register("rolling_snapshots_hour", HOURS_SQL, ("hist_events",))
def q_rolling_snapshots_hour(spark, sf):
    """Hourly snapshots of one day."""
    return _hours(spark, sf)


@register("rolling_snapshots_month", MONTHS_SQL, ("hist_orders",))
def q_rolling_snapshots_month(spark, sf):
    """Monthly snapshots of one year."""
    return _months(spark, sf)


@register("expire_snapshots_hour", f"SELECT * FROM ({HOURS_SQL}) WHERE bucket >= '2024-01-01 13'", ("hist_events",))
def q_expire_snapshots_hour(spark, sf):
    """hourly snapshots kept for 12 hours."""
    return Fr.expire_snapshots(_hours(spark, sf), "hour", "2024-01-02 00:30:00", 12)


@register("expire_snapshots_month", f"SELECT * FROM ({MONTHS_SQL}) WHERE bucket >= '1996-10'", ("hist_orders",))
def q_expire_snapshots_month(spark, sf):
    """monthly snapshots kept for 3 months."""
    return Fr.expire_snapshots(_months(spark, sf), "month", "1996-12-31 12:00:00", 3)


def _throttle(grain: str, bucket: str) -> None:
    @register(f"calendar_throttle_{grain}", f"""
SELECT user_id AS source, strftime(ts, '{bucket}') AS bucket, min(ts) AS run_ts,
       arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id
FROM events GROUP BY 1, 2""")
    def q(spark, sf):
        return Fr.calendar_throttle(X._t(spark, sf, "events"), grain, source="user_id")
    q.__doc__ = f"F10: {grain} runs per user."


for _grain, _bucket in (("hourly", "%Y-%m-%d %H"), ("daily", "%Y-%m-%d"), ("monthly", "%Y-%m"), ("always", "%Y-%m-%d %H:%M:%S")):
    _throttle(_grain, _bucket)


@register("retention_hold_months", f"""
SELECT {HC}, CASE WHEN freq = 1 THEN deleted < TIMESTAMP '2001-07-01'
                  WHEN freq = 30 THEN deleted < date_trunc('day', TIMESTAMP '{NOW_ORDERS}') + INTERVAL 1 DAY
                  WHEN freq = 720 THEN deleted < date_trunc('hour', TIMESTAMP '{NOW_ORDERS}') + INTERVAL 1 HOUR
                  ELSE TRUE END AS eligible
FROM hist_orders WHERE freq <> 0""", ("hist_orders",))
def q_retention_hold_months(spark, sf):
    """monthly snapshots kept for 3 months."""
    return Fr.retention_hold(X.hist_orders(spark, sf), NOW_ORDERS, months=3)


@register("retention_budget_sidecars", f"""
WITH side AS (SELECT dirname, filename, substr(objname, 1, 19) AS p, sum(length(objname)) AS side FROM store_files
              WHERE ends_with(objname, '.par2') GROUP BY 1, 2, 3),
cand AS (SELECT {HC}, size FROM event_sizes WHERE freq <> 0),
w AS (SELECT cand.*, CASE WHEN type = 'd' THEN 0 ELSE size + coalesce(side, 0) END AS frees
      FROM cand LEFT JOIN side ON side.dirname = cand.dirname AND side.filename = cand.filename
       AND side.p = strftime(cand.created, '%Y-%m-%d %H:%M:%S')),
run AS (SELECT * EXCLUDE (frees), CAST(coalesce(sum(frees) OVER (
          ORDER BY deleted, dirname, filename, created, row_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS freed_before FROM w)
SELECT * FROM run WHERE freed_before < 100000""", ("event_sizes", "store_files"))
def q_retention_budget_sidecars(spark, sf):
    """oldest end first until 100000 bytes are free, protection sidecars included."""
    side = X.store_files(spark, sf).filter(F.col("objname").endswith(".par2")).withColumn("size", F.length("objname").cast("long"))
    return Fr.retention_budget(Fr.retention_fifo(X.event_sizes(spark, sf)), 100000, order="fifo", sidecars=side)


@register("protect_order_newest", ELIG_SQL + " ORDER BY created DESC, dirname, filename", ("hist_orders",))
def q_protect_order_newest(spark, sf):
    """K2: newest first."""
    return K.protect_order(K.protect_eligible(X.hist_orders(spark, sf), NOW_ORDERS), "newest")


@register("protect_order_random", ELIG_SQL, ("hist_orders",))
def q_protect_order_random(spark, sf):
    """K2: a repeatable random order (the rows are compared, not their order)."""
    return K.protect_order(K.protect_eligible(X.hist_orders(spark, sf), NOW_ORDERS), "random", seed=7)


@register("protect_eligible_window", """
SELECT * FROM hist_orders WHERE type = 'f' AND freq < 2
AND created >= TIMESTAMP '1999-09-01' AND created < TIMESTAMP '2001-03-01'""", ("hist_orders",))
def q_protect_eligible_window(spark, sf):
    """K1: started between 24 and 6 months ago."""
    return K.protect_eligible(X.hist_orders(spark, sf), NOW_ORDERS, newer_than=24, older_than=6)


@register("snap_start_all", f"""
SELECT dirname, freq, CASE
  WHEN freq = 1 THEN date_trunc('month', oldest) WHEN freq = 5 THEN date_trunc('week', oldest)
  WHEN freq = 30 THEN date_trunc('day', oldest) WHEN freq = 720 THEN date_trunc('hour', oldest)
  WHEN freq = 8640 THEN date_trunc('minute', oldest) - to_minutes(CAST(minute(oldest) % 5 AS BIGINT))
  ELSE date_trunc('minute', oldest) END AS start
FROM ({OLDEST_SQL})""", ("hist_events",))
def q_snap_start_all(spark, sf):
    """Segment starts when everything is shown."""
    return D.timeline_starts(X.hist_events(spark, sf), show_all=True)


@register("dedup_candidates_guarded", """
WITH d AS (SELECT * REPLACE (CASE WHEN starts_with(dirname, './g3/') THEN 0 ELSE inode END AS inode) FROM hist_dups)
SELECT v.inode, v.dirname, v.filename, v.row_id, v.created, v.deleted, g.span_from, g.span_to, g.members, FALSE AS guarded
FROM d v
JOIN (SELECT inode, dirname, filename, min(created) AS span_from, max(deleted) AS span_to, count(*) AS members
      FROM d WHERE type = 'f' GROUP BY ALL HAVING count(*) > 1) g USING (inode, dirname, filename)
ANTI JOIN (SELECT dirname, filename FROM d GROUP BY ALL HAVING count(DISTINCT inode) > 1) held USING (dirname, filename)
WHERE v.type = 'f' AND (v.created > g.span_from OR v.deleted < g.span_to)""",
          ("hist_dups",))
def q_dedup_candidates_guarded(spark, sf):
    """G1 with the guard as intended: paths that hold another inode are left alone (here all but those below g3)."""
    h = X.hist_dups(spark, sf)
    h = h.withColumn("inode", F.when(F.col("dirname").startswith("./g3/"), F.lit(0).cast("long")).otherwise(F.col("inode")))
    return G.dedup_candidates(h, guard="intended")


@register("parse_rejects", """
SELECT 'inventory' AS source, '?' || CAST(inode AS VARCHAR) AS value FROM hist_inv WHERE inode % 3 = 0
UNION ALL
SELECT 'store', 'no times ' || CAST(inode AS VARCHAR) FROM hist_inv WHERE inode % 3 = 1
UNION ALL
SELECT 'log', 'sending incremental file list ' || CAST(inode AS VARCHAR) FROM hist_inv WHERE inode % 3 = 2""", ("hist_inv",))
def q_parse_rejects(spark, sf):
    """A1, A3, A5: lines in no known form come back as rejects, the others do not."""
    h = X.hist_inv(spark, sf)
    number = F.col("inode").cast("string")

    def bad(rest: int, text: str):
        return h.filter(F.col("inode") % 3 == rest).select(F.concat(F.lit(text), number).alias("value"))

    inventory = P.parse_inventory(W.listing_lines(h).select("value").unionByName(bad(0, "?")))[1]
    store = P.parse_version_store(W.store_lines(h).select("value").unionByName(bad(1, "no times ")))[1]
    log = P.parse_change_log(bad(2, "sending incremental file list ").withColumn("seq", F.lit(1).cast("long")))[1]
    return (inventory.select(F.lit("inventory").alias("source"), "value").unionByName(store.select(F.lit("store").alias("source"), "value"))
            .unionByName(log.select(F.lit("log").alias("source"), "value")))


@register("append_run_stats", """
SELECT event_type AS source, strftime(date_trunc('day', ts), '%Y-%m-%d') AS run, CAST(count(*) AS VARCHAR) AS number_of_created_files
FROM events GROUP BY 1, 2""")
def q_append_run_stats(spark, sf):
    """Daily statistics of each event type, parsed from log lines and appended in two runs to one table."""
    e = X._t(spark, sf, "events")
    lines = e.groupBy(F.col("event_type").alias("source"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n")).select(
        F.concat_ws("|", "source", "day").alias("run"), F.concat(F.lit("Number of created files: "), F.col("n").cast("string")).alias("value"))
    stats = P.parse_run_stats(lines, ["number_of_created_files"]).select(
        F.substring_index("run", "|", 1).alias("source"), F.substring_index("run", "|", -1).alias("run"), "number_of_created_files")
    path = scratch_path(spark, "run-stats")
    S.append_run_stats(stats.filter("run < '2024-01-15'"), path)
    return S.append_run_stats(stats.filter("run >= '2024-01-15'"), path)

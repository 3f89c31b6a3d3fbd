"""Registered queries: debounce (L1-L4) and the streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import empty_history, read_table
from ..streaming import debounce as L
from ..streaming import streams as St
from . import fixtures as X
from .fixtures import OPEN_SQL, freq_sql
from .registry import register

GAP, MAX, RUN = 6 * 3600, 24 * 3600, 10 * 3600


def _debounce_sql(gap_s: int, max_s: int) -> str:
    g, th = gap_s * 1000000, (max_s - gap_s) * 1000000
    return f"""
WITH RECURSIVE ev AS (
  SELECT user_id AS k, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
walk(k, rn, t0, a, b) AS (
  SELECT k, rn, t, t + {g}, 1 FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn,
         CASE WHEN e.t >= w.a THEN e.t ELSE w.t0 END,
         CASE WHEN e.t >= w.a THEN e.t + {g} WHEN e.t - w.t0 < {th} THEN e.t + {g} ELSE w.a END,
         CASE WHEN e.t >= w.a THEN w.b + 1 ELSE w.b END
  FROM walk w JOIN ev e ON e.k = w.k AND e.rn = w.rn + 1)
SELECT k AS key, make_timestamp(t0) AS batch_start, make_timestamp(max(a)) AS fire_at, count(*) AS n_events
FROM walk GROUP BY k, b, t0"""


@register("debounce", _debounce_sql(GAP, MAX), headline=True)
def q_debounce(spark, sf):
    """L1: run 6 h after the last event of a user, at most 24 h after the first."""
    return L.debounce(read_table(spark, sf, "events"), "user_id", "ts", GAP, MAX)


@register("debounce_as_written", _debounce_sql(GAP, GAP))
def q_debounce_as_written(spark, sf):
    """L2: the script as written never postpones: fixed 6 h windows from the first event."""
    return L.debounce(read_table(spark, sf, "events"), "user_id", "ts", GAP, GAP)


@register("debounce_jumps", _debounce_sql(GAP, MAX))
def q_debounce_jumps(spark, sf):
    """L1 by pointers to the next batch in place of a walk."""
    return L.debounce_by_jumps(read_table(spark, sf, "events"), "user_id", "ts", GAP, MAX)


@register("session_windows", f"""
SELECT k AS key, min(ts) AS session_start, max(ts) + INTERVAL {GAP} SECOND AS session_end, count(*) AS n_events
FROM (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL {GAP} SECOND THEN 1 ELSE 0 END)
                  OVER (PARTITION BY k ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
      FROM (SELECT user_id AS k, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events))
GROUP BY k, s""")
def q_session_windows(spark, sf):
    """L3: 6 h session windows per user."""
    return L.session_windows(read_table(spark, sf, "events"), "user_id", "ts", GAP)


def _busy_sql(gap_s: int, max_s: int, run_s: int) -> str:
    g, th, rn_ = gap_s * 1000000, (max_s - gap_s) * 1000000, run_s * 1000000
    ge = (f"CASE WHEN w.busy IS NOT NULL AND w.fire < w.busy "
          f"THEN w.fire + CAST(ceil((w.busy - w.fire) / {g}) AS BIGINT) * {g} ELSE w.fire END")
    return f"""
WITH RECURSIVE ev AS (
  SELECT user_id AS k, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         count(*) OVER (PARTITION BY user_id) AS cnt
  FROM events),
walk(k, rn, t0, fire, n, busy, e_t0, e_fire, e_n) AS (
  SELECT k, rn, t, t + {g}, 1, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT k, rn,
         CASE WHEN due THEN t ELSE t0 END,
         CASE WHEN due THEN t + {g} WHEN t - t0 < {th} THEN t + {g} ELSE f_gt END,
         CASE WHEN due THEN 1 ELSE n + 1 END,
         CASE WHEN due THEN f_ge + {rn_} ELSE busy END,
         CASE WHEN due THEN t0 END, CASE WHEN due THEN f_ge END, CASE WHEN due THEN n END
  FROM (SELECT e.k, e.rn, e.t, w.t0, w.n, w.busy, {ge} AS f_ge,
               CASE WHEN w.fire <= e.t THEN w.fire + ((e.t - w.fire) // {g} + 1) * {g} ELSE w.fire END AS f_gt,
               ({ge}) <= e.t AS due
        FROM walk w JOIN ev e ON e.k = w.k AND e.rn = w.rn + 1)),
ends AS (
  SELECT k, e_t0 AS t0, e_fire AS fire, e_n AS n FROM walk WHERE e_t0 IS NOT NULL
  UNION ALL
  SELECT w.k, w.t0, {ge}, w.n FROM walk w JOIN ev e ON e.k = w.k AND e.rn = w.rn WHERE e.rn = e.cnt)
SELECT k AS key, make_timestamp(t0) AS batch_start, make_timestamp(fire) AS fire_at, make_timestamp(fire) AS run_start,
       n AS n_events FROM ends"""


@register("busy_coalesce", _busy_sql(GAP, MAX, RUN))
def q_busy_coalesce(spark, sf):
    """L4: debounce with runs of 10 h that delay batches falling due meanwhile."""
    return L.busy_coalesce(read_table(spark, sf, "events"), "user_id", "ts", GAP, MAX, RUN)


@register("throttle_stream", """
SELECT user_id AS source, strftime(ts, '%Y-%m-%d') AS bucket, min(ts) AS run_ts,
       arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id
FROM events GROUP BY 1, 2""")
def q_throttle_stream(spark, sf):
    """Daily throttle over the events arriving as a file stream (4 files)."""
    src = St.event_stream(spark, St.split_events(spark, sf))
    return St.throttle_stream(src, "daily", spark, source="user_id")


@register("history_stream", f"""
WITH ti AS (SELECT t, row_number() OVER (ORDER BY t) AS idx, lead(t) OVER (ORDER BY t) AS next_t FROM snapshot_times),
s AS (SELECT d.*, ti.idx,
             ti.idx - row_number() OVER (PARTITION BY inode, type, dirname, filename ORDER BY ti.idx) AS isl
      FROM daily_states d JOIN ti ON d.t = ti.t),
g AS (SELECT inode, type, dirname, filename, min(t) AS created, max(idx) AS last_idx
      FROM s GROUP BY inode, type, dirname, filename, isl),
r AS (SELECT g.inode, g.type, g.dirname, g.filename, g.created, coalesce(ti.next_t, {OPEN_SQL}) AS deleted
      FROM g JOIN ti ON ti.idx = g.last_idx)
SELECT *, {freq_sql()} AS freq FROM r""", ("daily_states", "snapshot_times"))
def q_history_stream(spark, sf):
    """Daily listings arriving as a stream, each applied to the history (must equal B11)."""
    states = X.daily_states(spark, sf)
    # every day's rows plus one that says a listing was taken
    taken = X.snapshot_times(spark, sf).select("t", *[F.lit(None).cast(states.schema[c].dataType).alias(c) for c in states.columns if c != "t"])
    src = St.stream_in_time_order(states.unionByName(taken.select(*states.columns)), "t")
    return St.history_stream(src, spark, empty_history(spark)).drop("row_id")


@register("interval_stream", f"""
SELECT row_id, inode, type, dirname, filename, created, deleted FROM hist_events WHERE deleted <> {OPEN_SQL}""",
          ("hist_events",), headline=True)
def q_interval_stream(spark, sf):
    """Event versions arriving as a stream; each new version closes the open one."""
    src = St.stream_in_time_order(read_table(spark, sf, "events"), "ts")
    ch = src.select(
        F.concat(F.lit("./g"), (F.col("user_id") % 10).cast("string"), F.lit("/u"),
                 F.col("user_id").cast("string"), F.lit("/")).alias("dirname"),
        F.col("event_type").alias("filename"), F.col("event_id").alias("inode"),
        F.date_trunc("second", "ts").alias("created"))
    return St.interval_stream(ch, spark)


@register("debounce_stream", _debounce_sql(GAP, MAX) + """
HAVING max(a) < (SELECT max(epoch_us(ts)) FROM events)""")
def q_debounce_stream(spark, sf):
    """L1 on a file stream: batches emitted while the stream runs (the last pending ones are not)."""
    src = St.stream_in_time_order(read_table(spark, sf, "events"), "ts")
    return St.debounce_stream(src, spark, "user_id", "ts", GAP, MAX, delay="0 seconds").rows


@register("session_stream", f"""
SELECT * FROM (
SELECT k AS key, min(ts) AS session_start, max(ts) + INTERVAL {GAP} SECOND AS session_end, count(*) AS n_events
FROM (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL {GAP} SECOND THEN 1 ELSE 0 END)
                  OVER (PARTITION BY k ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
      FROM (SELECT user_id AS k, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events))
GROUP BY k, s) WHERE session_end <= (SELECT max(ts) FROM events)""")
def q_session_stream(spark, sf):
    """L3 on a file stream: 6 h sessions per user emitted as the watermark passes them."""
    src = St.stream_in_time_order(read_table(spark, sf, "events"), "ts")
    return St.session_stream(src, spark, "user_id", "ts", GAP, delay="0 seconds").rows


@register("debounce_as_written_stream", _debounce_sql(GAP, GAP) + """
HAVING max(a) < (SELECT max(epoch_us(ts)) FROM events)""")
def q_debounce_as_written_stream(spark, sf):
    """L2 on a file stream: fixed 6 h windows from the first event, emitted as the watermark passes."""
    src = St.stream_in_time_order(read_table(spark, sf, "events"), "ts")
    return St.debounce_stream(src, spark, "user_id", "ts", GAP, GAP, delay="0 seconds").rows

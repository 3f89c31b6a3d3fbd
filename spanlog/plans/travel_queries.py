"""Registered queries: classes (C*), time travel (D*) and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classes import freq_coarse, freq_label
from ..operators import reports as R
from ..operators import travel as D
from ..functions.paths import root_of
from . import fixtures as X
from .fixtures import FREQ, NOW_EVENTS, NOW_ORDERS
from .registry import register

T_ASOF = "2024-01-15 00:00:00"
TS = f"TIMESTAMP '{T_ASOF}'"
NOW = f"TIMESTAMP '{NOW_EVENTS}'"
HCOLS = "row_id, inode, type, dirname, filename, created, deleted, freq"

# ---------------------------------------------------------------- C: classes


@register("freq_class", f"""
SELECT row_id, created, deleted, {FREQ} AS freq
FROM hist_events_base
UNION ALL
SELECT row_id, created, deleted, {FREQ} AS freq FROM hist_orders_base""",
          ("hist_events_base", "hist_orders_base"), headline=True)
def q_freq_class(spark, sf):
    """Class of every version of two histories (events: fine classes; orders: month, NULL)."""
    from ..functions.classes import freq_class
    a = X.hist_events(spark, sf).select("row_id", "created", "deleted")
    b = X.hist_orders(spark, sf).select("row_id", "created", "deleted")
    return a.unionByName(b).withColumn("freq", freq_class("created", "deleted"))


@register("freq_coarse", """
SELECT row_id, freq, CAST(CASE WHEN freq <= 8640 THEN freq ELSE 43800 END AS BIGINT) AS shown
FROM (SELECT row_id, freq FROM hist_events UNION ALL SELECT row_id, freq FROM hist_orders)""",
          ("hist_events", "hist_orders"))
def q_freq_coarse(spark, sf):
    """C2."""
    u = X.hist_events(spark, sf).select("row_id", "freq").unionByName(X.hist_orders(spark, sf).select("row_id", "freq"))
    return u.withColumn("shown", freq_coarse("freq"))


@register("freq_label", """
SELECT freq, CASE freq WHEN 0 THEN 'now' WHEN 1 THEN 'month' WHEN 5 THEN 'week' WHEN 30 THEN 'day'
                       WHEN 720 THEN 'hour' WHEN 8640 THEN '5min' END AS label,
       count(*) AS n
FROM (SELECT freq FROM hist_events UNION ALL SELECT freq FROM hist_orders) GROUP BY ALL""",
          ("hist_events", "hist_orders"))
def q_freq_label(spark, sf):
    """Label of each class with its number of versions."""
    u = X.hist_events(spark, sf).select("freq").unionByName(X.hist_orders(spark, sf).select("freq"))
    return u.groupBy("freq").agg(F.count(F.lit(1)).alias("n")).withColumn("label", freq_label("freq"))


# ---------------------------------------------------------------- D: time travel

@register("snapshot_as_of", f"""
SELECT {HCOLS} FROM hist_events
WHERE starts_with(dirname, './') AND type <> 'd' AND created <= {TS} AND deleted > {TS}""",
          ("hist_events",), headline=True)
def q_snapshot_as_of(spark, sf):
    """What existed at T_ASOF, whole tree."""
    return D.snapshot_as_of(X.hist_events(spark, sf), T_ASOF, "./")


@register("list_dir", f"""
SELECT dirname, filename, type, created, deleted FROM hist_events
WHERE created <= {TS} AND deleted > {TS} AND filename <> '.'""", ("hist_events",))
def q_list_dir(spark, sf):
    """Listing of every directory at T_ASOF."""
    return D.list_dir(X.hist_events(spark, sf), T_ASOF)


@register("live_view", f"""
SELECT {HCOLS} FROM hist_events WHERE deleted = TIMESTAMP '2199-12-31 00:00:00'""", ("hist_events",))
def q_live_view(spark, sf):
    """D3."""
    return D.live_view(X.hist_events(spark, sf))


@register("list_versions", """
SELECT dirname, filename, created, deleted, freq,
       CASE freq WHEN 0 THEN 'now' WHEN 1 THEN 'month' WHEN 5 THEN 'week' WHEN 30 THEN 'day'
                 WHEN 720 THEN 'hour' WHEN 8640 THEN '5min' END AS label
FROM hist_events""", ("hist_events",))
def q_list_versions(spark, sf):
    """Versions of every path."""
    return D.list_versions(X.hist_events(spark, sf))


@register("get_version", """
SELECT h.dirname, h.filename, h.created, h.deleted, d.n_chars, sha256(d.text) AS content_digest
FROM hist_docs h JOIN documents d ON h.inode = d.doc_id""", ("hist_docs",))
def q_get_version(spark, sf):
    """Content of every version of the document history (whole texts digested)."""
    h = X.hist_docs(spark, sf).drop("size", "digest")
    docs = X._t(spark, sf, "documents")
    j = D.get_version(h, docs)
    return j.select("dirname", "filename", "created", "deleted", "n_chars",
                    F.sha2("text", 256).alias("content_digest"))


@register("bulk_as_of", """
SELECT p.probe_id, p.dirname, p.filename, p.t, h.row_id, h.inode, h.created, h.deleted
FROM (SELECT event_id AS probe_id,
             concat('./g', CAST(user_id % 10 AS VARCHAR), '/u', CAST(user_id AS VARCHAR), '/') AS dirname,
             event_type AS filename, CAST(date_trunc('second', ts) AS TIMESTAMP) + INTERVAL 30 MINUTE AS t
      FROM events) p
LEFT JOIN hist_events h ON h.dirname = p.dirname AND h.filename = p.filename AND h.created <= p.t AND h.deleted > p.t""",
          ("hist_events",), headline=True)
def q_bulk_as_of(spark, sf):
    """Every event probes the version of its key valid 30 minutes later."""
    e = X._t(spark, sf, "events")
    probes = e.select(
        F.col("event_id").alias("probe_id"),
        F.concat(F.lit("./g"), (F.col("user_id") % 10).cast("string"), F.lit("/u"),
                 F.col("user_id").cast("string"), F.lit("/")).alias("dirname"),
        F.col("event_type").alias("filename"),
        (F.date_trunc("second", "ts") + F.expr("INTERVAL 30 MINUTES")).alias("t"))
    return D.bulk_as_of(probes, X.hist_events(spark, sf))


@register("rolling_snapshots", """
SELECT strftime(b, '%Y-%m-%d') AS bucket, b AS boundary, dirname, filename, inode, created, deleted
FROM hist_events h
JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS b) g
  ON h.created <= g.b AND g.b < h.deleted
WHERE h.type <> 'd'""", ("hist_events",), headline=True)
def q_rolling_snapshots(spark, sf):
    """Daily snapshots of January 2024."""
    return D.rolling_snapshots(X.hist_events(spark, sf), "day", "2024-01-01 00:00:00", "2024-01-31 00:00:00")


@register("boundary_runs_strict", """
SELECT strftime(boundary, '%Y-%m') AS bucket, boundary, min(run_ts) AS run_ts, 'strict' AS kind
FROM (SELECT CAST(o_orderdate AS TIMESTAMP) AS run_ts, date_trunc('month', CAST(o_orderdate AS TIMESTAMP)) AS boundary
      FROM orders)
WHERE date_trunc('minute', run_ts) = boundary
GROUP BY boundary""")
def q_boundary_runs_strict(spark, sf):
    """D8 strict: monthly snapshots made only by a run at the month boundary (order dates as runs)."""
    runs = X._t(spark, sf, "orders").select(F.col("o_orderdate").alias("ts"))
    return D.boundary_runs(runs, "month", "strict")


@register("boundary_runs_loose", """
SELECT strftime(boundary, '%Y-%m-%d %H') AS bucket, boundary, min(run_ts) AS run_ts,
       CASE WHEN date_trunc('minute', min(run_ts)) = boundary THEN 'strict' ELSE 'loose' END AS kind
FROM (SELECT ts AS run_ts, date_trunc('hour', ts) AS boundary FROM events)
GROUP BY boundary""")
def q_boundary_runs_loose(spark, sf):
    """D8 loose: hourly snapshots made by the first run of each hour (events as runs)."""
    runs = X._t(spark, sf, "events").select("ts")
    return D.boundary_runs(runs, "hour", "loose")


CHANGES_SQL = """
SELECT DISTINCT dirname, t FROM (
  SELECT dirname, created AS t FROM hist_events
  UNION ALL
  SELECT dirname, deleted AS t FROM hist_events WHERE CASE WHEN freq <= 8640 THEN freq ELSE 43800 END <> 0)"""


@register("change_points", CHANGES_SQL, ("hist_events",))
def q_change_points(spark, sf):
    """Change times of every directory."""
    return D.change_points(X.hist_events(spark, sf))


OLDEST_SQL = """
SELECT dirname, CAST(CASE WHEN freq <= 8640 THEN freq ELSE 43800 END AS BIGINT) AS freq, min(deleted) AS oldest
FROM hist_events WHERE CASE WHEN freq <= 8640 THEN freq ELSE 43800 END <> 0 GROUP BY 1, 2"""


@register("oldest_per_class", OLDEST_SQL, ("hist_events",))
def q_oldest_per_class(spark, sf):
    """D10."""
    return D.oldest_per_class(X.hist_events(spark, sf))


STARTS_SQL = f"""
SELECT dirname, freq, CASE
  WHEN freq = 1 THEN date_trunc('month', oldest) + INTERVAL 1 MONTH
  WHEN freq = 5 THEN date_trunc('week', oldest) + INTERVAL 7 DAY
  WHEN freq = 30 THEN date_trunc('day', oldest) + INTERVAL 1 DAY
  WHEN freq = 720 THEN date_trunc('hour', oldest) + INTERVAL 1 HOUR
  WHEN freq = 8640 THEN date_trunc('minute', oldest) - to_minutes(CAST(minute(oldest) % 5 AS BIGINT)) + INTERVAL 5 MINUTE
  ELSE date_trunc('minute', oldest) + INTERVAL 1 MINUTE END AS start
FROM ({OLDEST_SQL})"""


@register("snap_start", STARTS_SQL, ("hist_events",))
def q_snap_start(spark, sf):
    """Timeline segment starts of every directory."""
    return D.timeline_starts(X.hist_events(spark, sf))


def _step_us_sql(f):
    return (f"(CASE {f} WHEN 5 THEN 604800 WHEN 30 THEN 86400 WHEN 720 THEN 3600 WHEN 8640 THEN 300 "
            f"ELSE 60 END) * CAST(1000000 AS BIGINT)")


THIN_SQL = f"""
WITH ch AS ({CHANGES_SQL}),
st AS ({STARTS_SQL}),
lastc AS (SELECT dirname, max(t) AS last_t FROM ch GROUP BY dirname),
seg0 AS (
  SELECT st.dirname, st.freq, st.start,
         coalesce(lead(st.start) OVER (PARTITION BY st.dirname ORDER BY st.freq), lastc.last_t) AS upper,
         CASE WHEN lag(st.start) OVER (PARTITION BY st.dirname ORDER BY st.freq) IS NULL THEN 1
              WHEN st.start < lag(st.start) OVER (PARTITION BY st.dirname ORDER BY st.freq) THEN 1 ELSE 0 END AS restart
  FROM st JOIN lastc ON st.dirname = lastc.dirname),
seg1 AS (
  SELECT *, sum(restart) OVER (PARTITION BY dirname ORDER BY freq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp,
         CASE WHEN start < upper THEN
           CASE WHEN freq = 1 THEN
             (SELECT max(g) FROM (SELECT unnest(generate_series(start, upper, INTERVAL 1 MONTH)) AS g) WHERE g < upper)
           ELSE make_timestamp(epoch_us(start) + ((epoch_us(upper) - epoch_us(start) - 1) // ({_step_us_sql('freq')})) * ({_step_us_sql('freq')}))
           END END AS lastgrid
  FROM seg0),
seg AS (
  SELECT *, max(lastgrid) OVER (PARTITION BY dirname, grp ORDER BY freq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cons
  FROM seg1),
mapped AS (
  SELECT seg.dirname, seg.freq, seg.upper,
         greatest(seg.start, CASE WHEN seg.freq = 1 THEN
             (SELECT min(g) FROM (SELECT unnest(generate_series(seg.start, ch.t + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS g) WHERE g >= ch.t)
           ELSE make_timestamp(epoch_us(seg.start) + CAST(ceil((epoch_us(ch.t) - epoch_us(seg.start)) / ({_step_us_sql('seg.freq')})) AS BIGINT) * ({_step_us_sql('seg.freq')}))
           END) AS g
  FROM ch JOIN seg ON ch.dirname = seg.dirname
  WHERE seg.cons IS NULL OR ch.t > seg.cons)
SELECT DISTINCT dirname, freq, g AS t FROM mapped WHERE g < upper"""


@register("thin_timeline", THIN_SQL, ("hist_events",), headline=True)
def q_thin_timeline(spark, sf):
    """Thinned timeline of every directory."""
    h = X.hist_events(spark, sf)
    return D.thin_timeline(D.change_points(h), D.timeline_starts(h))


@register("timeline_ticks", f"""
WITH st AS ({STARTS_SQL}), tl AS ({THIN_SQL.replace('WITH ch AS', 'WITH ch AS', 1)})
SELECT * FROM st WHERE EXISTS (SELECT 1 FROM tl WHERE tl.dirname = st.dirname AND tl.t = st.start)""",
          ("hist_events",))
def q_timeline_ticks(spark, sf):
    """D13."""
    h = X.hist_events(spark, sf)
    st = D.timeline_starts(h)
    return D.timeline_ticks(st, D.thin_timeline(D.change_points(h), st))


@register("export_subtree", f"""
SELECT split_part(substr(dirname, 3), '/', 1) AS root, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total_size
FROM hist_docs WHERE starts_with(dirname, './') AND type <> 'd' AND created <= {TS} AND deleted > {TS}
GROUP BY 1""", ("hist_docs",))
def q_export_subtree(spark, sf):
    """Files and bytes of every top directory of the document tree at T_ASOF."""
    return D.export_subtree(X.hist_docs(spark, sf), T_ASOF, "./")


@register("filter_masks", """
SELECT * FROM page_paths WHERE regexp_matches(filename, '^(.*\\.html|25.*)$', 'i')""", ("page_paths",))
def q_filter_masks(spark, sf):
    """Page paths named *.html or 25*."""
    return D.filter_masks(X.page_paths(spark, sf), ["*.html", "25*"])


# ---------------------------------------------------------------- E: reports

@register("count_versions", "SELECT count(*) AS n_versions FROM hist_events", ("hist_events",))
def q_count_versions(spark, sf):
    """E1."""
    return R.count_versions(X.hist_events(spark, sf))


@register("count_per_root", """
SELECT substr(dirname, 3, instr(substr(dirname, 3), '/') - 1) AS root, count(*) AS n_versions
FROM hist_events WHERE dirname <> './' GROUP BY 1""", ("hist_events",), headline=True)
def q_count_per_root(spark, sf):
    """E2."""
    return R.count_per_root(X.hist_events(spark, sf))


@register("most_changed", """
SELECT dirname, filename, count(*) AS num FROM hist_events GROUP BY 1, 2
ORDER BY num DESC, dirname, filename LIMIT 10""", ("hist_events",))
def q_most_changed(spark, sf):
    """Top 10 paths by versions."""
    return R.most_changed(X.hist_events(spark, sf), 10)


@register("oldest_deleted_per_class", """
SELECT freq, min(deleted) AS oldest FROM hist_events WHERE freq <> 0 GROUP BY freq""", ("hist_events",))
def q_oldest_deleted_per_class(spark, sf):
    """E4."""
    return R.oldest_deleted_per_class(X.hist_events(spark, sf))


@register("last_activity", f"""
WITH roots AS (SELECT DISTINCT split_part(substr(dirname, 3), '/', 1) AS root FROM live_all),
agg AS (SELECT split_part(substr(dirname, 3), '/', 1) AS root,
               max(CASE WHEN freq = 0 THEN created END) AS c, max(CASE WHEN freq <> 0 THEN deleted END) AS d
        FROM hist_events WHERE dirname <> './' GROUP BY 1)
SELECT r.root, 'created' AS direction, a.c AS last_backup,
       round((epoch_us({NOW}) - epoch_us(a.c)) / 86400e6, 2) AS days_ago
FROM roots r LEFT JOIN agg a ON r.root = a.root
UNION ALL
SELECT r.root, 'deleted', a.d, round((epoch_us({NOW}) - epoch_us(a.d)) / 86400e6, 2)
FROM roots r LEFT JOIN agg a ON r.root = a.root""", ("hist_events", "live_all"))
def q_last_activity(spark, sf):
    """E5: per live root the newest start and the newest end."""
    roots = X.live_all(spark, sf).select(root_of("dirname").alias("root"))
    return R.last_activity(X.hist_events(spark, sf), roots, NOW_EVENTS)


@register("latest_in_dir", f"""
SELECT dirname, arg_max(filename, struct_pack(c := created, f := filename)) AS filename, max(created) AS created,
       round((epoch_us({NOW}) - epoch_us(max(created))) / 86400e6, 2) AS days_ago
FROM hist_events WHERE freq = 0 AND dirname LIKE './g%/u%/' GROUP BY dirname""", ("hist_events",))
def q_latest_in_dir(spark, sf):
    """Newest open version in every user directory."""
    return R.latest_in_dir(X.hist_events(spark, sf), "./g%/u%/", NOW_EVENTS)


@register("class_age", f"""
SELECT freq, min(deleted) AS oldest,
       round(CAST(((CAST(floor(epoch({NOW})) AS BIGINT) - CAST(floor(epoch(min(deleted))) AS BIGINT)) * freq) // 2592000 AS DOUBLE), 2) AS age
FROM hist_events WHERE freq <> 0 AND freq <= 8640 GROUP BY freq""", ("hist_events",))
def q_class_age(spark, sf):
    """E7."""
    return R.class_age(X.hist_events(spark, sf), NOW_EVENTS)


@register("class_age_orders", f"""
SELECT freq, min(deleted) AS oldest,
       round(CAST(((CAST(floor(epoch(TIMESTAMP '{NOW_ORDERS}')) AS BIGINT) - CAST(floor(epoch(min(deleted))) AS BIGINT)) * freq) // 2592000 AS DOUBLE), 2) AS age
FROM hist_orders WHERE freq <> 0 AND freq <= 8640 GROUP BY freq""", ("hist_orders",))
def q_class_age_orders(spark, sf):
    """E7 on the order history (month class)."""
    return R.class_age(X.hist_orders(spark, sf), NOW_ORDERS)


@register("usage_per_root", """
WITH u AS (
  SELECT split_part(substr(dirname, 3), '/', 1) AS root, size AS live_b, NULL::BIGINT AS store_b
  FROM event_sizes WHERE deleted = TIMESTAMP '2199-12-31 00:00:00'
  UNION ALL
  SELECT split_part(substr(dirname, 3), '/', 1), NULL::BIGINT, size FROM event_sizes)
SELECT CASE WHEN grouping(root) = 1 THEN '.' ELSE root END AS name,
       CAST(sum(live_b) AS BIGINT) AS live_bytes, CAST(sum(store_b) AS BIGINT) AS store_bytes
FROM u GROUP BY ROLLUP (root)""", ("event_sizes",))
def q_usage_per_root(spark, sf):
    """Live vs stored bytes per root with a total line."""
    es = X.event_sizes(spark, sf)
    live = es.filter(F.col("freq") == 0).select("dirname", "size")
    return R.usage_per_root(live, es.select("dirname", "size"))

"""Registered queries: retention (F*), dedup (G*, E12) and hierarchy (I*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.paths import full_path
from ..model import history_columns
from ..operators import dedup as G
from ..operators import reports as R
from ..operators import retention as Fr
from ..operators import travel as D
from ..operators import tree as I
from . import fixtures as X
from .fixtures import NOW_EVENTS, OPEN_SQL, freq_sql
from .registry import register

NOW = f"TIMESTAMP '{NOW_EVENTS}'"
EP = "CAST(floor(epoch({})) AS BIGINT)"
HC = "row_id, inode, type, dirname, filename, created, deleted, freq"

SCORE_SQL = f"""SELECT {HC}, freq * ({EP.format(NOW)} + 1 - {EP.format('deleted')}) AS age,
       dirname || filename || '/' || strftime(created, '%Y-%m-%d %H:%M:%S') AS store_prefix
FROM {{src}} WHERE freq <> 0"""
HOLD_EXPR = f"""CASE WHEN freq = 1 THEN deleted < date_trunc('month', {NOW}) + INTERVAL 1 MONTH
                     WHEN freq = 30 THEN deleted < date_trunc('day', {NOW}) + INTERVAL (-6) DAY
                     WHEN freq = 720 THEN deleted < date_trunc('hour', {NOW}) + INTERVAL (-23) HOUR
                     ELSE TRUE END"""


@register("retention_score", SCORE_SQL.format(src="hist_events"), ("hist_events",))
def q_retention_score(spark, sf):
    """F1."""
    return Fr.retention_score(X.hist_events(spark, sf), NOW_EVENTS)


@register("retention_hold", f"SELECT {HC}, {HOLD_EXPR} AS eligible FROM hist_events WHERE freq <> 0",
          ("hist_events",))
def q_retention_hold(spark, sf):
    """daily snapshots kept 7 days, hourly 24 hours, no monthly ones."""
    return Fr.retention_hold(X.hist_events(spark, sf), NOW_EVENTS, 0, 7, 24)


@register("retention_fifo", f"SELECT {HC} FROM hist_events WHERE freq <> 0 ORDER BY deleted", ("hist_events",))
def q_retention_fifo(spark, sf):
    """F3."""
    return Fr.retention_fifo(X.hist_events(spark, sf))


BUDGET_SQL = f"""
WITH cand AS (
  SELECT s.*, size FROM (SELECT {HC}, size, freq * ({EP.format(NOW)} + 1 - {EP.format('deleted')}) AS age,
                                dirname || filename || '/' || strftime(created, '%Y-%m-%d %H:%M:%S') AS store_prefix,
                                {HOLD_EXPR} AS eligible
                         FROM event_sizes WHERE freq <> 0) s WHERE eligible),
need AS (SELECT sum(size) // 10 AS shortfall FROM cand),
run AS (SELECT cand.*, CAST(coalesce(sum(CASE WHEN type = 'd' THEN 0 ELSE size END) OVER (
          ORDER BY age DESC, dirname, filename, created, row_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS freed_before FROM cand)
SELECT {HC}, size, age, store_prefix, eligible, freed_before FROM run, need WHERE freed_before < need.shortfall"""


@register("retention_budget", BUDGET_SQL, ("event_sizes",), headline=True)
def q_retention_budget(spark, sf):
    """victims freeing a tenth of the deletable bytes, in score order."""
    es = X.event_sizes(spark, sf)
    cand = Fr.retention_hold(Fr.retention_score(es, NOW_EVENTS), NOW_EVENTS, 0, 7, 24)
    cand = cand.filter(F.col("eligible"))
    shortfall = cand.agg(F.expr("sum(size) div 10")).scalar()
    return Fr.retention_budget(cand, shortfall)


@register("retention_budget_fifo", f"""
WITH cand AS (SELECT {HC}, size FROM event_sizes WHERE freq <> 0),
need AS (SELECT sum(size) // 10 AS shortfall FROM cand),
run AS (SELECT cand.*, CAST(coalesce(sum(CASE WHEN type = 'd' THEN 0 ELSE size END) OVER (
          ORDER BY deleted, dirname, filename, created, row_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS freed_before FROM cand)
SELECT {HC}, size, freed_before FROM run, need WHERE freed_before < need.shortfall""", ("event_sizes",))
def q_retention_budget_fifo(spark, sf):
    """F3 + F4: oldest end first (class ignored, no hold), until a tenth of the closed bytes is free."""
    cand = Fr.retention_fifo(X.event_sizes(spark, sf))
    shortfall = cand.agg(F.expr("sum(size) div 10")).scalar()
    return Fr.retention_budget(cand, shortfall, order="fifo")


@register("space_target", """
WITH u AS (SELECT CAST(sum(size) // 1024 AS BIGINT) AS total_mb FROM doc_inv),
v AS (SELECT total_mb, CAST(floor(total_mb * 0.05) AS BIGINT) AS free_mb FROM u)
SELECT total_mb, free_mb, total_mb // 100 * 10 AS needed_mb,
       greatest(total_mb // 100 * 10 - free_mb, 0) AS shortfall_mb,
       free_mb < total_mb // 100 * 10 AS must_clean FROM v""", ("doc_inv",))
def q_space_target(spark, sf):
    """10 % of the disk must be free."""
    return Fr.space_target(Fr.usage_mb(X.doc_inv(spark, sf)), 10, "%")


@register("delete_where", f"SELECT {HC} FROM hist_events WHERE coalesce(filename = 'error' AND freq = 720, FALSE)",
          ("hist_events",))
def q_delete_where(spark, sf):
    """victims of a predicate."""
    return Fr.delete_where(X.hist_events(spark, sf), "filename = 'error' AND freq = 720")[1]


@register("delete_prefix", f"SELECT {HC} FROM hist_events WHERE NOT starts_with(dirname, './g3/')", ("hist_events",))
def q_delete_prefix(spark, sf):
    """F7."""
    return Fr.delete_prefix(X.hist_events(spark, sf), "./g3/")


@register("purge_sidecars", """
SELECT s.* FROM store_files s JOIN (
  SELECT DISTINCT dirname, filename, strftime(created, '%Y-%m-%d %H:%M:%S') AS p
  FROM hist_events WHERE coalesce(filename = 'error' AND freq = 720, FALSE)) v
ON s.dirname = v.dirname AND s.filename = v.filename AND starts_with(s.objname, v.p)""",
          ("hist_events", "store_files"))
def q_purge_sidecars(spark, sf):
    """F8: store objects (and sidecars) of the F6 victims."""
    victims = Fr.delete_where(X.hist_events(spark, sf), "filename = 'error' AND freq = 720")[1]
    return Fr.purge_sidecars(victims, X.store_files(spark, sf))


@register("expire_snapshots", """
SELECT strftime(b, '%Y-%m-%d') AS bucket, b AS boundary, dirname, filename, inode, created, deleted
FROM hist_events h
JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS b) g
  ON h.created <= g.b AND g.b < h.deleted
WHERE h.type <> 'd' AND strftime(b, '%Y-%m-%d') >= '2024-01-25'""", ("hist_events",))
def q_expire_snapshots(spark, sf):
    """daily snapshots kept for 7 days."""
    snaps = D.rolling_snapshots(X.hist_events(spark, sf), "day", "2024-01-01 00:00:00", "2024-01-31 00:00:00")
    return Fr.expire_snapshots(snaps, "day", NOW_EVENTS, 7)


@register("calendar_throttle", """
SELECT user_id AS source, strftime(ts, '%Y %W') AS bucket, min(ts) AS run_ts,
       arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id
FROM events GROUP BY 1, 2""")
def q_calendar_throttle(spark, sf):
    """weekly runs per user (Monday weeks numbered within the year)."""
    e = X._t(spark, sf, "events")
    return Fr.calendar_throttle(e, "weekly", source="user_id")


# ---------------------------------------------------------------- G: dedup

CAND_SQL = """
SELECT v.inode, v.dirname, v.filename, v.row_id, v.created, v.deleted, g.span_from, g.span_to, g.members, FALSE AS guarded
FROM hist_dups v
JOIN (SELECT inode, dirname, filename, min(created) AS span_from, max(deleted) AS span_to, count(*) AS members
      FROM hist_dups WHERE type = 'f' GROUP BY ALL HAVING count(*) > 1) g USING (inode, dirname, filename)
WHERE v.type = 'f' AND (v.created > g.span_from OR v.deleted < g.span_to)"""


@register("dedup_candidates", CAND_SQL, ("hist_dups",))
def q_dedup_candidates(spark, sf):
    """G1."""
    return G.dedup_candidates(X.hist_dups(spark, sf))


@register("dedup_merge", f"""
WITH cand AS ({CAND_SQL}),
kept AS (SELECT {HC} FROM hist_dups WHERE row_id NOT IN (SELECT row_id FROM cand)),
new AS (SELECT min(row_id) AS row_id, arg_min(inode, row_id) AS inode, 'f' AS type, dirname, filename,
               span_from AS created, span_to AS deleted
        FROM cand GROUP BY dirname, filename, span_from, span_to),
new2 AS (SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.inode = n.inode AND k.dirname = n.dirname
          AND k.filename = n.filename AND k.created = n.created AND k.deleted = n.deleted))
SELECT * FROM kept UNION ALL SELECT *, {freq_sql()} FROM new2""", ("hist_dups",), headline=True)
def q_dedup_merge(spark, sf):
    """G2."""
    h = X.hist_dups(spark, sf)
    return G.dedup_merge(h, G.dedup_candidates(h))


@register("path_guard", """
SELECT dirname, filename, min(inode) AS min_inode, max(inode) AS max_inode FROM hist_dups
GROUP BY 1, 2 HAVING min(inode) <> max(inode)""", ("hist_dups",))
def q_path_guard(spark, sf):
    """G3."""
    return G.path_guard(X.hist_dups(spark, sf))


@register("content_duplicates", """
WITH d AS (SELECT doc_id, text, sha256(text) AS digest FROM documents),
g AS (SELECT digest, min(doc_id) AS keep_id FROM d GROUP BY digest HAVING count(*) > 1)
SELECT d.doc_id, g.keep_id, d.digest FROM d JOIN g ON d.digest = g.digest JOIN d k ON k.doc_id = g.keep_id
WHERE d.doc_id <> g.keep_id AND d.text = k.text""", headline=True)
def q_content_duplicates(spark, sf):
    """Exact copies among the documents (whole texts)."""
    return G.content_duplicates(X._t(spark, sf, "documents"))


@register("dedup_counters", f"""
WITH cand AS ({CAND_SQL})
SELECT count(*) AS total_dups, count(DISTINCT (dirname, filename, span_from, span_to)) AS total_groups FROM cand""",
          ("hist_dups",))
def q_dedup_counters(spark, sf):
    """E12."""
    return R.dedup_counters(G.dedup_candidates(X.hist_dups(spark, sf)))


# ---------------------------------------------------------------- I: hierarchy

# every proper prefix of a row's directory is a directory, as old as its oldest row and as long-lived as its last
ROLLUP_SQL = """
SELECT CAST(0 AS BIGINT) AS inode, 'd' AS type, array_to_string(parts[1:i], '/') || '/' AS dirname, parts[i + 1] AS filename,
       min(first) AS created, max(last) AS deleted
FROM (SELECT string_split(rtrim(dirname, '/'), '/') AS parts, created AS first, deleted AS last FROM {src}) x,
     LATERAL (SELECT unnest(range(1, len(x.parts))) AS i)
GROUP BY 3, 4"""

# live directories take the smallest id below them
LIVE_DIRS_SQL = """
SELECT array_to_string(parts[1:i], '/') || '/' AS dirname, parts[i + 1] AS filename, min(inode) AS inode
FROM (SELECT string_split(rtrim(dirname, '/'), '/') AS parts, inode FROM live_all) x,
     LATERAL (SELECT unnest(range(1, len(x.parts))) AS i)
GROUP BY 1, 2"""


@register("rollup_ancestors", ROLLUP_SQL.format(src="hist_events"), ("hist_events",), headline=True)
def q_rollup_ancestors(spark, sf):
    """I1."""
    return I.rollup_ancestors(X.hist_events(spark, sf))


def _live_dirs(spark, sf):
    from ..functions.paths import ancestor_dirs
    lv = X.live_all(spark, sf).groupBy("dirname").agg(F.min("inode").alias("m"))
    x = lv.select(F.explode(ancestor_dirs("dirname")).alias("a"), "m")
    return x.groupBy(F.col("a.parent").alias("dirname"), F.col("a.name").alias("filename")).agg(
        F.min("m").alias("inode"))


@register("upsert_dir_ids", f"""
WITH dirs AS ({ROLLUP_SQL.format(src='hist_events')}),
live AS ({LIVE_DIRS_SQL}),
mn AS (SELECT min(created) AS m FROM (SELECT created FROM hist_events UNION ALL SELECT created FROM dirs)),
up AS (SELECT coalesce(l.inode, d.inode) AS inode, 'd' AS type, coalesce(d.dirname, l.dirname) AS dirname,
              coalesce(d.filename, l.filename) AS filename, coalesce(d.created, (SELECT m FROM mn)) AS created,
              CASE WHEN l.inode IS NOT NULL THEN {OPEN_SQL} ELSE d.deleted END AS deleted
       FROM dirs d FULL OUTER JOIN live l ON d.dirname = l.dirname AND d.filename = l.filename)
SELECT inode, type, dirname, filename, created, deleted, freq FROM hist_events
UNION ALL
SELECT *, {freq_sql()} FROM up""", ("hist_events", "live_all"))
def q_upsert_dir_ids(spark, sf):
    """Directory versions get the live directory ids; new ones are inserted."""
    h = history_columns(X.hist_events(spark, sf))
    dirs = I.rollup_ancestors(h)
    dirs = dirs.select(F.xxhash64("dirname", "filename").alias("row_id"), *dirs.columns).withColumn(
        "freq", F.lit(None).cast("long"))
    from ..functions.classes import freq_class
    dirs = dirs.withColumn("freq", freq_class("created", "deleted"))
    return I.upsert_dir_ids(h.unionByName(dirs), _live_dirs(spark, sf)).drop("row_id")


@register("min_created", "SELECT min(created) AS min_created FROM hist_events", ("hist_events",))
def q_min_created(spark, sf):
    """I3."""
    return I.min_created(X.hist_events(spark, sf))


@register("root_of", "SELECT inode, split_part(substr(dirname, 3), '/', 1) AS root FROM page_paths",
          ("page_paths",))
def q_root_of(spark, sf):
    """I4."""
    return I.root_names(X.page_paths(spark, sf))


@register("breadcrumbs", """
SELECT inode, i AS depth, array_to_string(list_slice(parts, 1, i), '/') AS crumb
FROM (SELECT inode, string_split(dirname || filename, '/') AS parts FROM page_paths) p,
     LATERAL (SELECT unnest(generate_series(1, len(p.parts))) AS i)""", ("page_paths",))
def q_breadcrumbs(spark, sf):
    """I5."""
    pp = X.page_paths(spark, sf).withColumn("path", full_path())
    return I.path_breadcrumbs(pp).withColumn("depth", F.col("depth").cast("long"))


@register("empty_dirs", """
WITH both_listings AS (SELECT * FROM inv_prev UNION ALL SELECT * FROM inv_cur),
used AS (
  SELECT DISTINCT './' || array_to_string(list_slice(parts, 1, i), '/') || '/' AS p
  FROM (SELECT string_split(substr(dirname, 3), '/') AS parts FROM (SELECT DISTINCT dirname FROM both_listings WHERE type <> 'd')) x,
       LATERAL (SELECT unnest(generate_series(1, len(x.parts) - 1)) AS i))
SELECT c.* FROM both_listings c WHERE c.type = 'd'
AND NOT EXISTS (SELECT 1 FROM used WHERE used.p = c.dirname || c.filename || '/')""", ("inv_prev", "inv_cur"))
def q_empty_dirs(spark, sf):
    """I6, over all parts: those of the listing before and those of the current one."""
    return I.empty_dirs(X.inv_prev(spark, sf).unionByName(X.inv_cur(spark, sf)))


@register("normalize_path", """
SELECT page_id AS inode, path,
       regexp_extract(q, '^(.*/)[^/]*$', 1) AS dirname, regexp_extract(q, '([^/]*)$', 1) AS filename
FROM (SELECT page_id, path,
             CASE WHEN starts_with(r, './') OR r = '.' THEN r ELSE './' || r END AS q
      FROM (SELECT page_id, path, regexp_replace(path, '/$', '') AS r
            FROM (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path
                  FROM pages)))""")
def q_normalize_path(spark, sf):
    """Raw page paths (some with a trailing '/') to (dirname, filename)."""
    pg = X._t(spark, sf, "pages").select(
        F.col("page_id").alias("inode"),
        F.regexp_replace(F.regexp_replace("url", r"^https?://", ""), r"[?#].*$", "").alias("path"))
    return I.normalize_paths(pg)


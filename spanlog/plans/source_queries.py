"""Registered queries: moves (J*), protection (K*, E10, E11) and text sources (A*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.paths import ancestor_dirs
from ..model import empty_history, history_columns, with_freq
from ..operators import moves as J
from ..operators import protect as K
from ..operators import reports as R
from ..operators import tree as I
from ..session import reliable_checkpoint, scratch_path
from ..sources import files as S
from ..sources import parsers as P
from ..sources import render as W
from . import fixtures as X
from .fixtures import INV_CREATED, NOW_ORDERS, OPEN_SQL, freq_sql
from .upkeep_queries import LIVE_DIRS_SQL, ROLLUP_SQL
from .registry import register

# ---------------------------------------------------------------- J: moved directories


def _moves(spark, sf):
    """The change log is read many times by the detection; it is materialised once in the shared folder."""
    return reliable_checkpoint(X.moves(spark, sf))


MEMBERS_SQL = """
f AS (SELECT seq AS file_seq, path AS file, op FROM moves WHERE op IN ('new_file', 'del_file') AND path NOT IN ('Thumbs.db')),
fx AS (SELECT file, file_seq, op, array_to_string(list_slice(string_split(file, '/'), 1, i), '/') || '/' AS dir
       FROM f, LATERAL (SELECT unnest(generate_series(1, len(string_split(f.file, '/')) - 1)) AS i)),
dn AS (SELECT seq AS dir_seq, path AS dir FROM moves WHERE op = 'new_dir'),
dd AS (SELECT seq AS dir_seq, path AS dir FROM moves WHERE op = 'del_dir'),
nm AS (SELECT DISTINCT dn.dir, dn.dir_seq, substr(fx.file, length(dn.dir) + 1) AS rel
       FROM fx JOIN dn ON fx.dir = dn.dir WHERE fx.op = 'new_file' AND dn.dir_seq < fx.file_seq),
om AS (SELECT DISTINCT dd.dir, dd.dir_seq, substr(fx.file, length(dd.dir) + 1) AS rel
       FROM fx JOIN dd ON fx.dir = dd.dir WHERE fx.op = 'del_file' AND fx.file_seq < dd.dir_seq)"""
BEST_SQL = MEMBERS_SQL + """,
pairs AS (SELECT nm.dir AS new_dir, om.dir AS old_dir, om.dir_seq AS old_seq, count(*) AS matches
          FROM nm JOIN om ON nm.rel = om.rel GROUP BY 1, 2, 3),
best AS (SELECT new_dir, arg_max(old_dir, struct_pack(m := matches, s := -old_seq)) AS old_dir, max(matches) AS matches
         FROM pairs GROUP BY new_dir),
ncount AS (SELECT dir, count(*) AS n_files FROM nm GROUP BY dir),
acc AS (SELECT b.new_dir, b.old_dir, b.matches, dn.dir_seq AS new_seq, coalesce(n.n_files, 0) AS n_files
        FROM best b JOIN dn ON dn.dir = b.new_dir LEFT JOIN ncount n ON n.dir = b.new_dir
        WHERE b.matches >= 1 AND b.matches * 100.0 / coalesce(n.n_files, 0) >= 10),
pr AS (SELECT a.* FROM acc a WHERE NOT EXISTS (
         SELECT 1 FROM acc b WHERE b.new_dir <> a.new_dir AND starts_with(a.new_dir, b.new_dir)))"""


@register("dir_members", f"""
WITH {MEMBERS_SQL}
SELECT 'new' AS side, dir, dir_seq, rel FROM nm UNION ALL SELECT 'del', dir, dir_seq, rel FROM om""", ("moves",))
def q_dir_members(spark, sf):
    """Files below each new and each deleted directory, relative to it."""
    ch = _moves(spark, sf)
    a = J.dir_members(ch, "new")[1].withColumn("side", F.lit("new"))
    b = J.dir_members(ch, "del")[1].withColumn("side", F.lit("del"))
    return a.unionByName(b)


@register("best_move", f"WITH {BEST_SQL} SELECT * FROM acc", ("moves",))
def q_best_move(spark, sf):
    """J2."""
    return J.best_move(_moves(spark, sf)).withColumn("matches", F.col("matches").cast("long"))


@register("prune_nested", f"WITH {BEST_SQL} SELECT * FROM pr", ("moves",))
def q_prune_nested(spark, sf):
    """J3."""
    return J.prune_nested(J.best_move(_moves(spark, sf))).withColumn("matches", F.col("matches").cast("long"))


@register("copy_plan", f"""
WITH {BEST_SQL}
SELECT old_dir, new_dir, matches, CAST(floor(matches * 100.0 / n_files) AS BIGINT) AS pct,
       printf('cp -al %s %s # %d matched (%d%%)', old_dir, new_dir, matches, CAST(floor(matches * 100.0 / n_files) AS BIGINT)) AS line
FROM pr""", ("moves",), headline=True)
def q_copy_plan(spark, sf):
    """The move plan of the sync."""
    return J.detect_moves(_moves(spark, sf))


# ---------------------------------------------------------------- K: protection audit

ELIG_SQL = f"""SELECT * FROM hist_orders WHERE type = 'f' AND freq < 2
               AND created < date_trunc('month', TIMESTAMP '{NOW_ORDERS}')"""
CUT = "TIMESTAMP '2000-01-01 00:00:00'"


def _eligible(spark, sf):
    return K.protect_eligible(X.hist_orders(spark, sf), NOW_ORDERS)


def _orders_manifest(spark, sf):
    e = _eligible(spark, sf).filter(F.col("created") < F.to_timestamp(F.lit("2000-01-01 00:00:00")))
    return e.select("dirname", "filename", "created")


@register("protect_eligible", ELIG_SQL, ("hist_orders",))
def q_protect_eligible(spark, sf):
    """K1."""
    return _eligible(spark, sf)


@register("protect_order", ELIG_SQL + " ORDER BY dirname, filename, created", ("hist_orders",))
def q_protect_order(spark, sf):
    """K2 (directory order)."""
    return K.protect_order(_eligible(spark, sf), "dir")


@register("protect_tier", "SELECT *, CASE WHEN size < 5000 THEN 'copy' ELSE 'parity' END AS tier FROM doc_inv",
          ("doc_inv",))
def q_protect_tier(spark, sf):
    """K3 with a 5000-byte limit."""
    return K.protect_tier(X.doc_inv(spark, sf), 5000)


@register("protect_pending", f"""
WITH e AS ({ELIG_SQL})
SELECT e.* FROM e WHERE NOT EXISTS (
  SELECT 1 FROM e m WHERE m.created < {CUT} AND m.dirname = e.dirname AND m.filename = e.filename AND m.created = e.created)""",
          ("hist_orders",))
def q_protect_pending(spark, sf):
    """K4: versions not protected by a run that covered everything before 2000."""
    return K.protect_pending(_eligible(spark, sf), _orders_manifest(spark, sf))


MANIFEST_SQL = """SELECT h.dirname, h.filename, h.created, sha256(d.text) AS digest, CAST(strlen(d.text) AS BIGINT) AS size,
       CASE WHEN strlen(d.text) < 5000 THEN 'copy' ELSE 'parity' END AS tier
FROM hist_docs h JOIN documents d ON h.inode = d.doc_id"""


def _doc_manifest(spark, sf):
    h = X.hist_docs(spark, sf).select("inode", "dirname", "filename", "created")
    v = h.join(X._t(spark, sf, "documents").withColumnRenamed("doc_id", "inode"), "inode")
    return K.build_manifest(v, limit=5000)


@register("build_manifest", MANIFEST_SQL, ("hist_docs",), headline=True)
def q_build_manifest(spark, sf):
    """K5: digests of the whole texts of all document versions."""
    return _doc_manifest(spark, sf)


VERIFY_SQL = f"""
WITH m AS ({MANIFEST_SQL}),
cur AS (SELECT concat('./', source, '/', lang, '/') AS dirname, concat('doc', CAST(doc_id AS VARCHAR)) AS filename,
               TIMESTAMP '{INV_CREATED}' AS created, sha256(text) AS now_digest FROM docs_changed)
SELECT coalesce(cur.dirname, m.dirname) AS dirname, coalesce(cur.filename, m.filename) AS filename,
       coalesce(cur.created, m.created) AS created, cur.now_digest, m.digest,
       CASE WHEN m.digest IS NULL THEN 'not_protected' WHEN cur.now_digest IS NULL THEN 'target_missing'
            WHEN m.digest = cur.now_digest THEN 'ok' ELSE 'differs' END AS status
FROM cur FULL OUTER JOIN m ON cur.dirname = m.dirname AND cur.filename = m.filename AND cur.created = m.created"""


def _verify(spark, sf):
    c = X.docs_changed(spark, sf).select(
        F.concat(F.lit("./"), "source", F.lit("/"), "lang", F.lit("/")).alias("dirname"),
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("filename"),
        F.to_timestamp(F.lit(INV_CREATED)).alias("created"), "text")
    return K.verify_manifest(c, _doc_manifest(spark, sf))


@register("verify_manifest", VERIFY_SQL, ("hist_docs", "docs_changed"))
def q_verify_manifest(spark, sf):
    """K6: changed and removed documents against the manifest."""
    return _verify(spark, sf)


@register("resolve_renamed", """
WITH g AS (SELECT dirname, filename, created, count(*) AS n, max(deleted) AS deleted FROM store_obj GROUP BY 1, 2, 3)
SELECT r.dirname, r.filename, r.created, CASE WHEN coalesce(g.n, 0) = 1 THEN g.deleted END AS deleted,
       CASE WHEN coalesce(g.n, 0) = 1 THEN 'resolved' WHEN coalesce(g.n, 0) = 0 THEN 'missing' ELSE 'ambiguous' END AS status
FROM hist_events r LEFT JOIN g ON r.dirname = g.dirname AND r.filename = g.filename AND r.created = g.created""",
          ("hist_events", "store_obj"))
def q_resolve_renamed(spark, sf):
    """K7: every version requested as still open, resolved against the store."""
    return K.resolve_renamed(X.hist_events(spark, sf), X.store_obj(spark, sf))


@register("verify_summary", f"WITH v AS ({VERIFY_SQL}) SELECT status, count(*) AS n FROM v GROUP BY status",
          ("hist_docs", "docs_changed"))
def q_verify_summary(spark, sf):
    """K8."""
    return K.verify_summary(_verify(spark, sf))


@register("protection_bytes", """
SELECT CAST(sum(s) AS BIGINT) AS sidecar_bytes FROM (
  SELECT size AS s FROM doc_inv WHERE size < 5000
  UNION ALL SELECT size // 10 FROM doc_inv WHERE size >= 5000
  UNION ALL SELECT size // 5 FROM doc_inv WHERE size >= 5000)""", ("doc_inv",))
def q_protection_bytes(spark, sf):
    """Bytes of protection sidecars of the document store."""
    return R.protection_bytes(K.sidecar_files(X.doc_inv(spark, sf), 5000))


@register("protection_coverage", f"""
WITH e AS ({ELIG_SQL}),
j AS (SELECT e.*, EXISTS (SELECT 1 FROM e m WHERE m.created < {CUT} AND m.dirname = e.dirname
                          AND m.filename = e.filename AND m.created = e.created) AS sec FROM e)
SELECT count(*) AS total, count(*) FILTER (WHERE sec) AS secured,
       (count(*) FILTER (WHERE sec)) * 100 // nullif(count(*), 0) AS pct FROM j""", ("hist_orders",))
def q_protection_coverage(spark, sf):
    """E11."""
    return R.protection_coverage(_eligible(spark, sf), _orders_manifest(spark, sf))


@register("protection_progress", f"""
WITH e AS ({ELIG_SQL}),
j AS (SELECT row_number() OVER w AS checked, CAST(count(*) FILTER (WHERE created < {CUT}) OVER w AS BIGINT) AS secured FROM e
      WINDOW w AS (ORDER BY dirname, filename, created, row_id, inode ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT * FROM j WHERE checked % 100 = 0""", ("hist_orders",))
def q_protection_progress(spark, sf):
    """E11, the counts after every hundred versions."""
    return R.protection_progress(_eligible(spark, sf), _orders_manifest(spark, sf))


# ---------------------------------------------------------------- A: sources and sinks

LISTING_LINES_SQL = "SELECT CAST(inode AS VARCHAR) || ' ' || type || ' ' || dirname || filename AS value FROM page_paths"


@register("parse_inventory", f"""
SELECT CAST(regexp_extract(value, '{P.LISTING_RE}', 1) AS BIGINT) AS inode, regexp_extract(value, '{P.LISTING_RE}', 2) AS type,
       regexp_extract(value, '{P.LISTING_RE}', 3) AS dirname, regexp_extract(value, '{P.LISTING_RE}', 4) AS filename
FROM ({LISTING_LINES_SQL}) WHERE regexp_matches(value, '{P.LISTING_RE}')""", ("page_paths",))
def q_parse_inventory(spark, sf):
    """A1: listing lines rendered from the page paths, parsed back."""
    return P.parse_inventory(W.listing_lines(X.page_paths(spark, sf)))[0]


@register("scan_files")
def q_scan_files(spark, sf):
    """A2: the parquet files of the data set as an inventory (no contents read)."""
    return S.scan_files(spark, sf, "*.parquet")


VNAME = ("strftime(created, '%Y-%m-%d %H:%M:%S') || '~' || CASE WHEN deleted = TIMESTAMP '2199-12-31 00:00:00' "
         "THEN 'now' ELSE strftime(deleted, '%Y-%m-%d %H:%M:%S') END")
STORE_RE = P.STORE_RE.format(sep="~")


@register("parse_version_store", f"""
WITH l AS (SELECT CAST(inode AS VARCHAR) || ' ' || type || ' ' || dirname || filename || '/' || {VNAME} AS value
           FROM hist_events)
SELECT CAST(regexp_extract(value, '{STORE_RE}', 1) AS BIGINT) AS inode, regexp_extract(value, '{STORE_RE}', 2) AS type,
       regexp_extract(value, '{STORE_RE}', 3) AS dirname, regexp_extract(value, '{STORE_RE}', 4) AS filename,
       strptime(regexp_extract(value, '{STORE_RE}', 5), '%Y-%m-%d %H:%M:%S') AS created,
       CASE WHEN regexp_extract(value, '{STORE_RE}', 6) = 'now' THEN {OPEN_SQL}
            ELSE strptime(regexp_extract(value, '{STORE_RE}', 6), '%Y-%m-%d %H:%M:%S') END AS deleted
FROM l WHERE regexp_matches(value, '{STORE_RE}')""", ("hist_events",))
def q_parse_version_store(spark, sf):
    """A3: version-store lines rendered from the history, parsed back."""
    return P.parse_version_store(W.store_lines(X.hist_events(spark, sf)))[0]


@register("format_version_path", f"""
SELECT inode, type, dirname, filename, dirname || filename || '/' || {VNAME} AS store_path FROM hist_events""",
          ("hist_events",))
def q_format_version_path(spark, sf):
    """A4."""
    return W.format_version_path(X.hist_events(spark, sf))


@register("parse_change_log", """
SELECT seq, op, path FROM moves""", ("moves",))
def q_parse_change_log(spark, sf):
    """A5: itemized sync lines rendered from the move fixture, parsed back."""
    return P.parse_change_log(W.change_lines(X.moves(spark, sf)))[0]


RUN_METRICS = ["number_of_created_files", "number_of_deleted_files", "total_file_size",
               "total_transferred_file_size"]


@register("parse_run_stats", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS run,
       CAST(count(*) AS VARCHAR) AS number_of_created_files,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS VARCHAR) AS number_of_deleted_files,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS VARCHAR) || ' bytes' AS total_file_size,
       CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'purchase'), 0) AS VARCHAR) || ' bytes'
         AS total_transferred_file_size
FROM events GROUP BY 1""")
def q_parse_run_stats(spark, sf):
    """Per-day run logs rendered from the events, parsed into one row per run."""
    e = X._t(spark, sf, "events")
    cents = F.round(F.col("value") * 100).cast("long")
    d = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(
        F.count(F.lit(1)).alias("a"), F.count(F.when(F.col("event_type") == "error", 1)).alias("b"),
        F.sum(cents).alias("c"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", cents)), F.lit(0)).alias("d"))
    lines = d.select("run", F.explode(F.array(
        F.concat(F.lit("Number of created files: "), F.col("a").cast("string")),
        F.concat(F.lit("Number of deleted files: "), F.col("b").cast("string")),
        F.concat(F.lit("Total file size: "), F.col("c").cast("string"), F.lit(" bytes")),
        F.concat(F.lit("Total transferred file size: "), F.col("d").cast("string"), F.lit(" bytes")),
    )).alias("value"))
    return P.parse_run_stats(lines, RUN_METRICS)


@register("parse_run_metrics", """
SELECT l_linestatus AS run, 'priority_' || regexp_replace(lower(l_returnflag), '[^a-z0-9]+', '_', 'g') AS metric,
       CAST(count(*) AS VARCHAR) AS val
FROM lineitem GROUP BY l_linestatus, l_returnflag""")
def q_parse_run_metrics(spark, sf):
    """A6, long form: counts per line status rendered as log lines; no metric list is needed."""
    g = X._t(spark, sf, "lineitem").groupBy(F.col("l_linestatus").alias("run"), "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return P.parse_run_metrics(g.select("run", F.concat(F.lit("Priority "), "l_returnflag", F.lit(": "), F.col("n").cast("string")).alias("value")))


@register("parse_snapshot_dirs", """
SELECT strptime(strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S'), '%Y-%m-%d_%H-%M-%S') AS t,
       min('/backups/' || o_orderpriority || '/daily/' || strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S')) AS path
FROM orders GROUP BY 1""")
def q_parse_snapshot_dirs(spark, sf):
    """Snapshot directory names rendered from order dates; one per time."""
    o = X._t(spark, sf, "orders")
    paths = o.select(F.concat(F.lit("/backups/"), "o_orderpriority", F.lit("/daily/"),
                              F.date_format("o_orderdate", "yyyy-MM-dd_HH-mm-ss")).alias("path"))
    return P.parse_snapshot_dirs(paths)


@register("commit_series", """
WITH l AS (SELECT l_orderkey * 8 + l_linenumber AS seq, 'c' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS hash,
                  CAST(l_shipdate AS TIMESTAMP) AS t FROM lineitem),
v AS (SELECT *, hash || ' ' || strftime(t, '%Y-%m-%d %H:%M:%S') || ' +0000' AS value FROM l)
SELECT seq, hash, t, '+0000' AS tz FROM (SELECT *, lag(t) OVER (ORDER BY seq, value) AS p FROM v)
WHERE p IS NULL OR p <> t""")
def q_commit_series(spark, sf):
    """Commit lines rendered from the line items; consecutive equal times dropped."""
    li = X._t(spark, sf, "lineitem")
    lines = li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("seq"),
        F.concat(F.lit("c"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                 F.lit(" "), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" +0000")).alias("value"))
    return P.commit_series(lines)


@register("init_history", "SELECT * FROM hist_events", ("hist_events",))
def q_init_history(spark, sf):
    """An empty history with the generated class, filled with the event versions."""
    base = history_columns(X.hist_events(spark, sf)).drop("freq")
    h = empty_history(spark).drop("freq").unionByName(base)
    return history_columns(with_freq(h))


def _live_dirs_of(live):
    g = live.groupBy("dirname").agg(F.min("inode").alias("m"))
    x = g.select(F.explode(ancestor_dirs("dirname")).alias("a"), "m")
    return x.groupBy(F.col("a.parent").alias("dirname"), F.col("a.name").alias("filename")).agg(
        F.min("m").alias("inode"))


@register("rebuild_history", f"""
WITH files AS (SELECT inode, type, dirname, filename, created, deleted FROM store_all),
dirs AS ({ROLLUP_SQL.format(src='files')}),
live AS ({LIVE_DIRS_SQL}),
mn AS (SELECT min(created) AS m FROM (SELECT created FROM files UNION ALL SELECT created FROM dirs)),
up AS (SELECT coalesce(l.inode, d.inode) AS inode, 'd' AS type, coalesce(d.dirname, l.dirname) AS dirname,
              coalesce(d.filename, l.filename) AS filename, coalesce(d.created, (SELECT m FROM mn)) AS created,
              CASE WHEN l.inode IS NOT NULL THEN {OPEN_SQL} ELSE d.deleted END AS deleted
       FROM dirs d FULL OUTER JOIN live l ON d.dirname = l.dirname AND d.filename = l.filename)
SELECT *, {freq_sql()} AS freq FROM files
UNION ALL
SELECT *, {freq_sql()} FROM up""", ("store_all", "live_all"), headline=True)
def q_rebuild_history(spark, sf):
    """A10: history rebuilt from version-store lines and the live directories."""
    store = P.parse_version_store(W.store_lines(X.store_all(spark, sf)))[0]
    return I.rebuild_history(store, _live_dirs_of(X.live_all(spark, sf))).drop("row_id")


@register("rebuild_live", f"""
SELECT inode, type, dirname, filename FROM store_all WHERE deleted = {OPEN_SQL}""", ("store_all",))
def q_rebuild_live(spark, sf):
    """A11."""
    return I.rebuild_live(X.store_all(spark, sf))


@register("write_delimited", """
SELECT CAST(row_id AS VARCHAR) AS row_id, CAST(inode AS VARCHAR) AS inode, type, dirname, filename,
       strftime(created, '%Y-%m-%d %H:%M:%S') AS created, strftime(deleted, '%Y-%m-%d %H:%M:%S') AS deleted,
       CAST(freq AS VARCHAR) AS freq
FROM hist_events""", ("hist_events",))
def q_write_delimited(spark, sf):
    """The history written as '|'-separated text to the shared folder and read back."""
    return S.write_delimited(X.hist_events(spark, sf), scratch_path(spark, "delimited"))


@register("block_digests", """
SELECT doc_id, CAST(b AS BIGINT) AS block, sha256(substr(text, b * 4096 + 1, 4096)) AS digest,
       CAST(length(substr(text, b * 4096 + 1, 4096)) AS BIGINT) AS chars
FROM documents, LATERAL (SELECT unnest(generate_series(0, greatest(CAST(ceil(length(text) / 4096) AS INTEGER), 1) - 1)) AS b)""")
def q_block_digests(spark, sf):
    """K5 option: per-block digests of the whole document texts."""
    return K.block_digests(X._t(spark, sf, "documents"), block=4096)

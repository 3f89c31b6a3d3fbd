"""Views over the given tables that put them into history form.

Each view exists twice: as a DataFrame builder (used by the registered
queries) and as SQL text for the DuckDB oracle (a CTE).  Modulo conditions
below seed faults (missing objects, changed inodes, duplicates) into whole
tables; they never thin the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import OPEN_TEXT, history_columns, open_ts, open_versions, read_table, ts, with_freq

# The "now" used with each history and the first snapshot time of inventories.
NOW_EVENTS = "2024-01-31 00:00:00"
NOW_ORDERS = "2001-09-01 00:00:00"
INV_CREATED = "2024-01-01 00:00:00"
OPEN_SQL = f"TIMESTAMP '{OPEN_TEXT}'"


# ----------------------------------------------------------------------------------------
# SQL (DuckDB) text of the class, shared by all oracle statements
# ----------------------------------------------------------------------------------------

def freq_sql(c: str = "created", d: str = "deleted", max_freq: int = 8640) -> str:
    slot = 2592000 // max_freq

    def tr(u, x):
        return f"date_trunc('{u}', {x} - INTERVAL 1 SECOND)"

    def ep(x):
        return f"CAST(floor(epoch({x})) AS BIGINT)"

    return (f"CAST(CASE WHEN {d} = {OPEN_SQL} THEN 0 "
            f"WHEN {tr('month', c)} <> {tr('month', d)} THEN 1 "
            f"WHEN {tr('week', c)} <> {tr('week', d)} THEN 5 "
            f"WHEN {tr('day', c)} <> {tr('day', d)} THEN 30 "
            f"WHEN {tr('hour', c)} <> {tr('hour', d)} THEN 720 "
            f"WHEN {ep(c + ' - INTERVAL 1 SECOND')} // {slot} <> {ep(d + ' - INTERVAL 1 SECOND')} // {slot} THEN {max_freq} "
            f"ELSE 2592000 // nullif({ep(d)} - {ep(c)}, 0) END AS BIGINT)")


FREQ = freq_sql()

SQL: dict[str, tuple[str, tuple[str, ...]]] = {}


def _sql(name: str, text: str, deps: tuple[str, ...] = ()):
    SQL[name] = (text.strip(), deps)


_sql("hist_events_base", f"""
SELECT event_id AS row_id, event_id AS inode, 'f' AS type,
       concat('./g', CAST(user_id % 10 AS VARCHAR), '/u', CAST(user_id AS VARCHAR), '/') AS dirname,
       event_type AS filename,
       CAST(date_trunc('second', ts) AS TIMESTAMP) AS created,
       coalesce(lead(CAST(date_trunc('second', ts) AS TIMESTAMP))
                  OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id), {OPEN_SQL}) AS deleted
FROM events""")
_sql("hist_events", f"SELECT *, {FREQ} AS freq FROM hist_events_base", ("hist_events_base",))

_sql("hist_orders_base", f"""
SELECT o_orderkey AS row_id, o_orderkey AS inode, 'f' AS type,
       concat('./p', CAST(o_custkey % 20 AS VARCHAR), '/c', CAST(o_custkey AS VARCHAR), '/') AS dirname,
       'order' AS filename, CAST(o_orderdate AS TIMESTAMP) AS created,
       coalesce(lead(CAST(o_orderdate AS TIMESTAMP))
                  OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), {OPEN_SQL}) AS deleted
FROM orders""")
_sql("hist_orders", f"SELECT *, {FREQ} AS freq FROM hist_orders_base", ("hist_orders_base",))

_sql("inv_prev", """
SELECT p_partkey AS inode, 'f' AS type,
       concat('./', replace(p_brand, '#', '_'), '/s', CAST(p_size AS VARCHAR), '/') AS dirname,
       concat('p', CAST(p_partkey AS VARCHAR)) AS filename
FROM part WHERE p_partkey % 7 <> 0 OR p_partkey % 5 = 0""")
_sql("inv_cur", """
SELECT p_partkey + CASE WHEN p_partkey % 11 = 0 THEN 1000000 ELSE 0 END AS inode,
       CASE WHEN p_partkey % 13 = 0 THEN 'd' ELSE 'f' END AS type,
       concat('./', replace(p_brand, '#', '_'), '/s', CAST(p_size AS VARCHAR), '/') AS dirname,
       concat('p', CAST(p_partkey AS VARCHAR)) AS filename
FROM part WHERE p_partkey % 5 <> 0""")
_sql("inv_dup", """
SELECT * FROM inv_cur
UNION ALL
SELECT inode + 2000000 AS inode, type, dirname, filename FROM inv_cur WHERE inode % 9 = 0""", ("inv_cur",))
_sql("hist_inv", f"""
SELECT inode AS row_id, inode, type, dirname, filename, TIMESTAMP '{INV_CREATED}' AS created,
       {OPEN_SQL} AS deleted, CAST(0 AS BIGINT) AS freq
FROM inv_prev""", ("inv_prev",))

_sql("doc_inv", """
SELECT doc_id AS inode, 'f' AS type, concat('./', source, '/', lang, '/') AS dirname,
       concat('doc', CAST(doc_id AS VARCHAR)) AS filename, n_chars AS size, sha256(text) AS digest
FROM documents""")
_sql("hist_docs", f"""
SELECT inode AS row_id, inode, type, dirname, filename, TIMESTAMP '{INV_CREATED}' AS created,
       {OPEN_SQL} AS deleted, CAST(0 AS BIGINT) AS freq, size, digest
FROM doc_inv""", ("doc_inv",))

_sql("page_paths", """
SELECT page_id AS inode, 'f' AS type,
       concat('./', regexp_extract(p, '^(.*/)[^/]*$', 1)) AS dirname, regexp_extract(p, '([^/]*)$', 1) AS filename
FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', ''), '/$', '') AS p
      FROM pages)""")

_sql("hist_dups", f"""
SELECT row_id, row_id % 3 AS inode, type, dirname, filename, created, deleted, freq FROM hist_events""",
     ("hist_events",))
_sql("store_obj", """
SELECT inode, type, dirname, filename, created, deleted FROM hist_events WHERE row_id % 97 <> 0""",
     ("hist_events",))
_sql("store_all", "SELECT inode, type, dirname, filename, created, deleted FROM hist_events", ("hist_events",))
_sql("live_all", f"SELECT inode, type, dirname, filename FROM hist_events WHERE deleted = {OPEN_SQL}", ("hist_events",))
_sql("live_obj", f"""
SELECT inode + CASE WHEN row_id % 83 = 0 THEN 1000000 ELSE 0 END AS inode, type, dirname, filename
FROM hist_events WHERE deleted = {OPEN_SQL} AND row_id % 19 <> 0""", ("hist_events",))
_sql("hist_overlap_base", f"""
SELECT row_id, inode, type, dirname, filename, created,
       CASE WHEN row_id % 50 = 0 AND deleted <> {OPEN_SQL} THEN deleted + INTERVAL 1 HOUR ELSE deleted END AS deleted
FROM hist_events""", ("hist_events",))
_sql("hist_overlap", f"SELECT *, {FREQ} AS freq FROM hist_overlap_base", ("hist_overlap_base",))
_sql("hist_open_dups", f"""
SELECT row_id, inode, type, dirname, filename, created,
       CASE WHEN row_id % 101 = 0 THEN {OPEN_SQL} ELSE deleted END AS deleted,
       CASE WHEN row_id % 101 = 0 THEN CAST(0 AS BIGINT) ELSE freq END AS freq
FROM hist_events""", ("hist_events",))
_sql("hist_faults_base", f"""
SELECT row_id, inode, type, dirname, filename, created,
       CASE WHEN row_id % 101 = 0 THEN {OPEN_SQL} ELSE deleted END AS deleted
FROM hist_overlap""", ("hist_overlap",))
_sql("hist_faults", f"SELECT *, {FREQ} AS freq FROM hist_faults_base", ("hist_faults_base",))
_sql("event_sizes", """
SELECT h.*, CAST(round(e.value * 100) AS BIGINT) AS size
FROM hist_events h JOIN events e ON h.row_id = e.event_id""", ("hist_events",))
_sql("docs_changed", """
SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN concat(text, 'x') ELSE text END AS text, lang, source, n_chars
FROM documents WHERE doc_id % 29 <> 0""")
_sql("daily_states", """
SELECT day AS t, concat('./g', CAST(user_id % 10 AS VARCHAR), '/') AS dirname,
       concat('u', CAST(user_id AS VARCHAR)) AS filename,
       CAST(ascii(last_type) * 100 + length(last_type) AS BIGINT) AS inode, 'f' AS type
FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, user_id,
             arg_max(event_type, struct_pack(ts := ts, id := event_id)) AS last_type
      FROM events GROUP BY 1, 2)""")
_sql("snapshot_times", """
SELECT DISTINCT CAST(date_trunc('day', ts) AS TIMESTAMP) AS t FROM events""")
# store objects as files: the version object itself plus one protection sidecar
_sql("store_files", """
SELECT dirname, filename, created, concat(strftime(created, '%Y-%m-%d %H:%M:%S'), '~',
         CASE WHEN deleted = TIMESTAMP '2199-12-31 00:00:00' THEN 'now' ELSE strftime(deleted, '%Y-%m-%d %H:%M:%S') END,
         x.suffix) AS objname
FROM store_all, (SELECT unnest(['', '.par2']) AS suffix) x""", ("store_all",))


def with_fixtures(body: str, *names: str) -> str:
    """Prefix an oracle statement with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in SQL[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS (\n{SQL[n][0]}\n)" for n in order)
    body = body.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


# ----------------------------------------------------------------------------------------
# DataFrame builders
# ----------------------------------------------------------------------------------------

def _t(spark, sf, name) -> DataFrame:
    return read_table(spark, sf, name)


def _next_within(df: DataFrame, keys: list[str], t: str, tie: str, col: str) -> DataFrame:
    """Value of ``col`` on the next row of the same key in (t, tie) order, by a
    range-partitioned scan in descending order (a hot key is split over tasks)."""
    from .ordered import keyed_scan
    d = df.withColumn("_nt", -F.unix_micros(F.col(t))).withColumn("_ni", -F.col(tie))
    s = keyed_scan(d, keys, ["_nt", "_ni"], lag=[col])
    return s.withColumnRenamed(f"lag_{col}", f"next_{col}").drop("_nt", "_ni")


_MATERIALISED: dict[tuple[str, str, str], str] = {}


def _as_table(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A history view stands for a stored history table: it is written once per application
    into the shared folder (partitioned by open/closed, sorted by key) and read back."""
    from ..session import scratch_path
    from ..sources.tables import read_history, write_history
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    path = _MATERIALISED.get(key)
    if path is None:
        path = scratch_path(spark, f"view-{name}")
        write_history(build(), path)
        _MATERIALISED[key] = path
    return read_history(spark, path)


def hist_events(spark: SparkSession, sf: str) -> DataFrame:
    return _as_table(spark, sf, "hist_events", lambda: _hist_events(spark, sf))


def hist_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _as_table(spark, sf, "hist_orders", lambda: _hist_orders(spark, sf))


def _hist_events(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    e = e.withColumn("created", F.date_trunc("second", F.col("ts")))
    e = _next_within(e, ["user_id", "event_type"], "ts", "event_id", "created")
    h = e.select(
        F.col("event_id").alias("row_id"), F.col("event_id").alias("inode"), F.lit("f").alias("type"),
        F.concat(F.lit("./g"), (F.col("user_id") % 10).cast("string"), F.lit("/u"),
                 F.col("user_id").cast("string"), F.lit("/")).alias("dirname"),
        F.col("event_type").alias("filename"),
        "created",
        F.coalesce(F.col("next_created"), open_ts()).alias("deleted"))
    return with_freq(h)


def _hist_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    o = _next_within(o, ["o_custkey"], "o_orderdate", "o_orderkey", "o_orderdate")
    h = o.select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderkey").alias("inode"), F.lit("f").alias("type"),
        F.concat(F.lit("./p"), (F.col("o_custkey") % 20).cast("string"), F.lit("/c"),
                 F.col("o_custkey").cast("string"), F.lit("/")).alias("dirname"),
        F.lit("order").alias("filename"),
        F.col("o_orderdate").alias("created"),
        F.coalesce(F.col("next_o_orderdate"), open_ts()).alias("deleted"))
    return with_freq(h)


def _part_dir():
    return F.concat(F.lit("./"), F.regexp_replace("p_brand", "#", "_"), F.lit("/s"),
                    F.col("p_size").cast("string"), F.lit("/"))


def inv_prev(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    k = F.col("p_partkey")
    return p.filter((k % 7 != 0) | (k % 5 == 0)).select(
        F.col("p_partkey").alias("inode"), F.lit("f").alias("type"), _part_dir().alias("dirname"),
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("filename"))


def inv_cur(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    k = F.col("p_partkey")
    return p.filter(k % 5 != 0).select(
        (k + F.when(k % 11 == 0, 1000000).otherwise(0)).alias("inode"),
        F.when(k % 13 == 0, "d").otherwise("f").alias("type"), _part_dir().alias("dirname"),
        F.concat(F.lit("p"), k.cast("string")).alias("filename"))


def inv_dup(spark, sf) -> DataFrame:
    c = inv_cur(spark, sf)
    return c.unionByName(c.filter(F.col("inode") % 9 == 0).withColumn("inode", F.col("inode") + 2000000))


def hist_inv(spark, sf) -> DataFrame:
    return inv_prev(spark, sf).select(
        F.col("inode").alias("row_id"), "inode", "type", "dirname", "filename",
        ts(INV_CREATED).alias("created"), open_ts().alias("deleted"), F.lit(0).cast("long").alias("freq"))


def doc_inv(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("inode"), F.lit("f").alias("type"),
        F.concat(F.lit("./"), "source", F.lit("/"), "lang", F.lit("/")).alias("dirname"),
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("filename"),
        F.col("n_chars").alias("size"), F.sha2("text", 256).alias("digest"))


def hist_docs(spark, sf) -> DataFrame:
    return doc_inv(spark, sf).select(
        F.col("inode").alias("row_id"), "inode", "type", "dirname", "filename",
        ts(INV_CREATED).alias("created"), open_ts().alias("deleted"), F.lit(0).cast("long").alias("freq"),
        "size", "digest")


def page_paths(spark, sf) -> DataFrame:
    pg = _t(spark, sf, "pages")
    p = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", r"^https?://", ""), r"[?#].*$", ""), r"/$", "")
    return pg.select("page_id", p.alias("p")).select(
        F.col("page_id").alias("inode"), F.lit("f").alias("type"),
        F.concat(F.lit("./"), F.regexp_extract("p", r"^(.*/)[^/]*$", 1)).alias("dirname"),
        F.regexp_extract("p", r"([^/]*)$", 1).alias("filename"))


def hist_dups(spark, sf) -> DataFrame:
    return hist_events(spark, sf).withColumn("inode", F.col("row_id") % 3)


def store_obj(spark, sf) -> DataFrame:
    return hist_events(spark, sf).filter(F.col("row_id") % 97 != 0).select(
        "inode", "type", "dirname", "filename", "created", "deleted")


def store_all(spark, sf) -> DataFrame:
    """The complete version store; ``store_obj`` misses objects, for the checks that look for them."""
    return hist_events(spark, sf).select("inode", "type", "dirname", "filename", "created", "deleted")


def live_all(spark, sf) -> DataFrame:
    """The complete live tree; ``live_obj`` misses objects and has changed ones."""
    return open_versions(hist_events(spark, sf)).select("inode", "type", "dirname", "filename")


def live_obj(spark, sf) -> DataFrame:
    h = hist_events(spark, sf)
    return h.filter((F.col("deleted") == open_ts()) & (F.col("row_id") % 19 != 0)).select(
        (F.col("inode") + F.when(F.col("row_id") % 83 == 0, 1000000).otherwise(0)).alias("inode"),
        "type", "dirname", "filename")


def hist_overlap(spark, sf) -> DataFrame:
    h = history_columns(hist_events(spark, sf))  # ends change: without is_open
    widen = (F.col("row_id") % 50 == 0) & (F.col("deleted") != open_ts())
    h = h.withColumn("deleted", F.when(widen, F.col("deleted") + F.expr("INTERVAL 1 HOUR"))
                     .otherwise(F.col("deleted")))
    return with_freq(h)


def hist_open_dups(spark, sf) -> DataFrame:
    h = history_columns(hist_events(spark, sf))  # ends change: without is_open
    hit = F.col("row_id") % 101 == 0
    return h.withColumn("deleted", F.when(hit, open_ts()).otherwise(F.col("deleted"))) \
            .withColumn("freq", F.when(hit, F.lit(0).cast("long")).otherwise(F.col("freq")))


def hist_faults(spark, sf) -> DataFrame:
    """Widened ends and reopened versions together: something to find for every check of the history."""
    h = hist_overlap(spark, sf)
    return with_freq(h.withColumn("deleted", F.when(F.col("row_id") % 101 == 0, open_ts()).otherwise(F.col("deleted"))))


def event_sizes(spark, sf) -> DataFrame:
    h = hist_events(spark, sf)
    e = _t(spark, sf, "events").select(F.col("event_id").alias("row_id"),
                                        F.round(F.col("value") * 100).cast("long").alias("size"))
    return h.join(e, "row_id")


def docs_changed(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents")
    return d.filter(F.col("doc_id") % 29 != 0).withColumn(
        "text", F.when(F.col("doc_id") % 17 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")))


def daily_states(spark, sf) -> DataFrame:
    e = _t(spark, sf, "events")
    last = (e.groupBy(F.date_trunc("day", "ts").alias("t"), "user_id")
            .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")))
    return last.select(
        "t",
        F.concat(F.lit("./g"), (F.col("user_id") % 10).cast("string"), F.lit("/")).alias("dirname"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("filename"),
        (F.ascii("last_type") * 100 + F.length("last_type")).cast("long").alias("inode"),
        F.lit("f").alias("type"))


def snapshot_times(spark, sf) -> DataFrame:
    return _t(spark, sf, "events").select(F.date_trunc("day", "ts").alias("t")).distinct()


def store_files(spark, sf) -> DataFrame:
    from ..sources.render import version_name
    s = store_all(spark, sf)
    base = s.select("dirname", "filename", "created", version_name().alias("objname"))
    side = base.withColumn("objname", F.concat("objname", F.lit(".par2")))
    return base.unionByName(side)


# ---------------------------------------------------------------------------------------
# change log of a sync in which the blog hosts were moved under moved/ (J*, A5)
# ---------------------------------------------------------------------------------------

_sql("moves", """
WITH p AS (SELECT inode AS page_id, substr(dirname, 3) || filename AS p, substr(dirname, 3) AS d,
                  split_part(substr(dirname, 3), '/', 1) || '/' AS host_dir, filename
           FROM page_paths),
blog AS (SELECT * FROM p WHERE starts_with(p, 'blog.'))
SELECT CAST(999999998 AS BIGINT) AS seq, 'new_dir' AS op, 'moved/' AS path
UNION ALL SELECT CAST(999999999 AS BIGINT), 'new_dir', 'fresh/'
UNION ALL SELECT 1000000000 + min(page_id) * 10 + 1, 'new_dir', 'moved/' || host_dir FROM blog GROUP BY host_dir
UNION ALL SELECT 1000000000 + min(page_id) * 10 + 2, 'new_dir', 'moved/' || d FROM blog GROUP BY d
UNION ALL SELECT 2000000000 + page_id * 10, 'new_file', 'moved/' || p FROM blog WHERE page_id % 10 <> 0
UNION ALL SELECT 2000000000 + page_id * 10 + 1, 'new_file', 'fresh/' || filename FROM p
          WHERE NOT starts_with(p, 'blog.')
UNION ALL SELECT 3000000000 + page_id * 10, 'del_file', p FROM blog
UNION ALL SELECT 4000000000 + min(page_id) * 10, 'del_dir', d FROM blog GROUP BY d
UNION ALL SELECT 5000000000 + min(page_id) * 10, 'del_dir', host_dir FROM blog GROUP BY host_dir""",
     ("page_paths",))


def moves(spark, sf) -> DataFrame:
    pp = page_paths(spark, sf).select(
        F.col("inode").alias("page_id"),
        F.concat(F.expr("substring(dirname, 3)"), "filename").alias("p"),
        F.expr("substring(dirname, 3)").alias("d"),
        F.concat(F.substring_index(F.expr("substring(dirname, 3)"), "/", 1), F.lit("/")).alias("host_dir"),
        "filename")
    blog = pp.filter(F.col("p").startswith("blog."))
    L = F.lit

    def rows(df, seq, op, path):
        return df.select(seq.cast("long").alias("seq"), L(op).alias("op"), path.alias("path"))

    fixed = spark.range(1).select(L(999999998).cast("long").alias("seq"), L("new_dir").alias("op"),
                                  L("moved/").alias("path")).unionByName(
        spark.range(1).select(L(999999999).cast("long").alias("seq"), L("new_dir").alias("op"),
                              L("fresh/").alias("path")))
    hosts = blog.groupBy("host_dir").agg(F.min("page_id").alias("m"))
    dirs = blog.groupBy("d").agg(F.min("page_id").alias("m"))
    parts = [
        fixed,
        rows(hosts, L(1000000000) + F.col("m") * 10 + 1, "new_dir", F.concat(L("moved/"), "host_dir")),
        rows(dirs, L(1000000000) + F.col("m") * 10 + 2, "new_dir", F.concat(L("moved/"), "d")),
        rows(blog.filter(F.col("page_id") % 10 != 0), L(2000000000) + F.col("page_id") * 10, "new_file",
             F.concat(L("moved/"), "p")),
        rows(pp.filter(~F.col("p").startswith("blog.")),
             L(2000000000) + F.col("page_id") * 10 + 1, "new_file", F.concat(L("fresh/"), "filename")),
        rows(blog, L(3000000000) + F.col("page_id") * 10, "del_file", F.col("p")),
        rows(dirs, L(4000000000) + F.col("m") * 10, "del_dir", F.col("d")),
        rows(hosts, L(5000000000) + F.col("m") * 10, "del_dir", F.col("host_dir")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

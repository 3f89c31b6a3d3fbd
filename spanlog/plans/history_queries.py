"""Registered queries: snapshot diff and upkeep (B*), checks (H*), E8 and E13."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import history_columns
from ..operators import checks as H
from ..operators import history as B
from ..operators import reports as R
from . import fixtures as X
from .fixtures import OPEN_SQL, freq_sql
from .registry import BODY, register

T2 = "2024-01-02 00:00:00"
T2S = f"TIMESTAMP '{T2}'"
SCOPE = "Brand_13"
NOROW = "inode, type, dirname, filename, created, deleted, freq"
EQ4 = "x.inode = c.inode AND x.type = c.type AND x.dirname = c.dirname AND x.filename = c.filename"


def _scope(alias: str, scope: str | None) -> str:
    return f" AND starts_with({alias}.dirname, './{scope}/')" if scope else ""


def new_sql(inv: str, h: str, scope: str | None = None) -> str:
    return (f"SELECT c.inode, c.type, c.dirname, c.filename FROM {inv} c WHERE NOT EXISTS ("
            f"SELECT 1 FROM {h} x WHERE x.deleted = {OPEN_SQL} AND {EQ4}{_scope('x', scope)}){_scope('c', scope)}")


def old_sql(inv: str, h: str, scope: str | None = None) -> str:
    return (f"SELECT x.* FROM {h} x WHERE x.deleted = {OPEN_SQL}{_scope('x', scope)} AND NOT EXISTS ("
            f"SELECT 1 FROM {inv} c WHERE {EQ4}{_scope('c', scope)})")


def closed_sql(h: str, old: str, t: str) -> str:
    hit = f"(o.dirname IS NOT NULL AND x.deleted = {OPEN_SQL})"
    return (f"SELECT x.row_id, x.inode, x.type, x.dirname, x.filename, x.created, "
            f"CASE WHEN {hit} THEN {t} ELSE x.deleted END AS deleted, "
            f"CASE WHEN {hit} THEN {freq_sql('x.created', t)} ELSE x.freq END AS freq "
            f"FROM {h} x LEFT JOIN (SELECT DISTINCT dirname, filename FROM {old}) o "
            f"ON x.dirname = o.dirname AND x.filename = o.filename")


def snapshot_ctes(h: str, inv: str, t: str, scope: str | None = None) -> str:
    """CTE text defining new_, old_, closed_, keep_, bad_ and hist2_ for one snapshot."""
    return f"""
new_ AS ({new_sql(inv, h, scope)}),
old_ AS ({old_sql(inv, h, scope)}),
closed_ AS ({closed_sql(h, 'old_', t)}),
still_ AS (SELECT DISTINCT dirname, filename FROM closed_ WHERE deleted = {OPEN_SQL}),
rest_ AS (SELECT n.* FROM new_ n WHERE NOT EXISTS (SELECT 1 FROM still_ s WHERE s.dirname = n.dirname AND s.filename = n.filename)),
keep_ AS (SELECT k.inode, k.type, dirname, filename FROM (
            SELECT dirname, filename, min(struct_pack(inode := inode, type := type)) AS k FROM rest_ GROUP BY 1, 2)),
bad_ AS (SELECT n.*, {t} AS created, {OPEN_SQL} AS deleted FROM new_ n
         WHERE EXISTS (SELECT 1 FROM still_ s WHERE s.dirname = n.dirname AND s.filename = n.filename)
         UNION ALL
         SELECT r.*, {t}, {OPEN_SQL} FROM rest_ r WHERE NOT EXISTS (
           SELECT 1 FROM keep_ k WHERE k.inode = r.inode AND k.type = r.type AND k.dirname = r.dirname AND k.filename = r.filename)),
hist2_ AS (SELECT {NOROW} FROM closed_
           UNION ALL
           SELECT inode, type, dirname, filename, {t}, {OPEN_SQL}, CAST(0 AS BIGINT) FROM keep_)"""


def _nr(df):
    return df.drop("row_id")


# ---------------------------------------------------------------- B: snapshot diff and upkeep

@register("diff_new", new_sql("inv_cur", "hist_inv"), ("inv_cur", "hist_inv"))
def q_diff_new(spark, sf):
    """B1."""
    return B.diff_new(X.inv_cur(spark, sf), X.hist_inv(spark, sf))


@register("diff_old", old_sql("inv_cur", "hist_inv"), ("inv_cur", "hist_inv"))
def q_diff_old(spark, sf):
    """B2."""
    return B.diff_old(X.inv_cur(spark, sf), X.hist_inv(spark, sf))


@register("diff_classify", f"""
SELECT coalesce(c.dirname, x.dirname) AS dirname, coalesce(c.filename, x.filename) AS filename,
       c.inode AS new_inode, c.type AS new_type, x.inode AS old_inode, x.type AS old_type,
       CASE WHEN x.inode IS NULL AND x.type IS NULL THEN 'added'
            WHEN c.inode IS NULL AND c.type IS NULL THEN 'removed'
            WHEN c.inode IS NOT DISTINCT FROM x.inode AND c.type IS NOT DISTINCT FROM x.type THEN 'unchanged'
            ELSE 'replaced' END AS status
FROM inv_cur c FULL OUTER JOIN (SELECT * FROM hist_inv WHERE deleted = {OPEN_SQL}) x
  ON c.dirname = x.dirname AND c.filename = x.filename""", ("inv_cur", "hist_inv"))
def q_diff_classify(spark, sf):
    """B3."""
    return B.diff_classify(X.inv_cur(spark, sf), X.hist_inv(spark, sf))


@register("close_versions", f"WITH old_ AS ({old_sql('inv_cur', 'hist_inv')}) {closed_sql('hist_inv', 'old_', T2S)}",
          ("inv_cur", "hist_inv"))
def q_close_versions(spark, sf):
    """B4."""
    h, inv = X.hist_inv(spark, sf), X.inv_cur(spark, sf)
    return B.close_versions(h, B.diff_old(inv, h), T2)


@register("insert_versions", f"""
SELECT {NOROW} FROM hist_inv
UNION ALL
SELECT inode, type, dirname, filename, {T2S}, {OPEN_SQL}, CAST(0 AS BIGINT) FROM ({new_sql('inv_cur', 'hist_inv')})""",
          ("inv_cur", "hist_inv"))
def q_insert_versions(spark, sf):
    """B5 (row ids are hashes; compared without them)."""
    h, inv = X.hist_inv(spark, sf), X.inv_cur(spark, sf)
    return _nr(B.insert_versions(h, B.diff_new(inv, h), T2))


@register("apply_snapshot", f"WITH {snapshot_ctes('hist_inv', 'inv_cur', T2S)} SELECT * FROM hist2_",
          ("inv_cur", "hist_inv"), headline=True)
def q_apply_snapshot(spark, sf):
    """One backup run: the next listing applied to the history."""
    return _nr(B.apply_snapshot(X.hist_inv(spark, sf), X.inv_cur(spark, sf), T2).history)


@register("scope_prefix", f"WITH {snapshot_ctes('hist_inv', 'inv_cur', T2S, SCOPE)} SELECT * FROM hist2_",
          ("inv_cur", "hist_inv"))
def q_scope_prefix(spark, sf):
    """A run restricted to one subtree; all other open versions stay."""
    return _nr(B.apply_snapshot(X.hist_inv(spark, sf), X.inv_cur(spark, sf), T2, scope=SCOPE).history)


@register("type_change", f"""
WITH {snapshot_ctes('hist_inv', 'inv_cur', T2S)}
SELECT dirname, filename, min(type) AS type_a, max(type) AS type_b, count(*) AS n_versions
FROM hist2_ GROUP BY 1, 2 HAVING min(type) <> max(type)""", ("inv_cur", "hist_inv"))
def q_type_change(spark, sf):
    """Paths that changed between file and directory."""
    return B.type_changes(B.apply_snapshot(X.hist_inv(spark, sf), X.inv_cur(spark, sf), T2).history)


@register("quarantine_conflicts", f"WITH {snapshot_ctes('hist_inv', 'inv_dup', T2S)} SELECT * FROM bad_",
          ("inv_dup", "hist_inv"))
def q_quarantine_conflicts(spark, sf):
    """A listing that holds some paths twice."""
    return B.apply_snapshot(X.hist_inv(spark, sf), X.inv_dup(spark, sf), T2).bad


@register("quarantine_report", f"""
WITH {snapshot_ctes('hist_inv', 'inv_dup', T2S)}
SELECT count(*) AS n_bad, count(DISTINCT (dirname, filename)) AS n_paths, min(created) AS first_created
FROM bad_ HAVING count(*) > 0""", ("inv_dup", "hist_inv"))
def q_quarantine_report(spark, sf):
    """E8."""
    return R.quarantine_report(B.apply_snapshot(X.hist_inv(spark, sf), X.inv_dup(spark, sf), T2).bad)


@register("assert_open_unique", f"""
SELECT dirname, filename, count(*) AS n_open FROM hist_open_dups WHERE deleted = {OPEN_SQL}
GROUP BY 1, 2 HAVING count(*) > 1""", ("hist_open_dups",))
def q_assert_open_unique(spark, sf):
    """B10 on a history with seeded second open versions."""
    return B.assert_open_unique(X.hist_open_dups(spark, sf))


@register("series_to_history", f"""
WITH ti AS (SELECT t, row_number() OVER (ORDER BY t) AS idx, lead(t) OVER (ORDER BY t) AS next_t FROM snapshot_times),
s AS (SELECT d.*, ti.idx,
             ti.idx - row_number() OVER (PARTITION BY inode, type, dirname, filename ORDER BY ti.idx) AS isl
      FROM daily_states d JOIN ti ON d.t = ti.t),
g AS (SELECT inode, type, dirname, filename, min(t) AS created, max(idx) AS last_idx
      FROM s GROUP BY inode, type, dirname, filename, isl),
r AS (SELECT g.inode, g.type, g.dirname, g.filename, g.created, coalesce(ti.next_t, {OPEN_SQL}) AS deleted
      FROM g JOIN ti ON ti.idx = g.last_idx)
SELECT *, {freq_sql()} AS freq FROM r""", ("daily_states", "snapshot_times"), headline=True)
def q_series_to_history(spark, sf):
    """Daily user states replayed into a history in one job."""
    return _nr(B.series_to_history(X.daily_states(spark, sf), X.snapshot_times(spark, sf)))


@register("changed_paths", f"""
SELECT 'new' AS kind, dirname || filename AS path FROM ({new_sql('inv_cur', 'hist_inv')}) WHERE type <> 'd'
UNION ALL
SELECT 'old', dirname || filename || '/' || strftime(created, '%Y-%m-%d %H:%M:%S')
FROM ({old_sql('inv_cur', 'hist_inv')}) WHERE type <> 'd'""", ("inv_cur", "hist_inv"))
def q_changed_paths(spark, sf):
    """B12."""
    h, inv = X.hist_inv(spark, sf), X.inv_cur(spark, sf)
    return B.changed_paths(B.diff_new(inv, h), B.diff_old(inv, h))


# ---------------------------------------------------------------- H: checks

HCOL = "x.row_id, x.inode, x.type, x.dirname, x.filename, x.created, x.deleted, x.freq"


@register("check_db2current", f"""
SELECT {HCOL} FROM hist_events x WHERE x.deleted = {OPEN_SQL}
AND NOT EXISTS (SELECT 1 FROM live_obj l WHERE l.dirname = x.dirname AND l.filename = x.filename)""",
          ("hist_events", "live_obj"))
def q_check_db2current(spark, sf):
    """H1."""
    return H.check_db2current(X.hist_events(spark, sf), X.live_obj(spark, sf))


@register("check_db2old", f"""
SELECT {HCOL} FROM hist_events x WHERE x.type <> 'd'
AND NOT EXISTS (SELECT 1 FROM store_obj s WHERE s.dirname = x.dirname AND s.filename = x.filename
                AND s.created = x.created AND s.deleted = x.deleted)""", ("hist_events", "store_obj"))
def q_check_db2old(spark, sf):
    """H2."""
    return H.check_db2old(X.hist_events(spark, sf), X.store_obj(spark, sf))


@register("check_current2db", f"""
SELECT l.* FROM live_obj l WHERE NOT EXISTS (
  SELECT 1 FROM hist_events x WHERE x.deleted = {OPEN_SQL} AND x.inode = l.inode
  AND x.dirname = l.dirname AND x.filename = l.filename)""", ("hist_events", "live_obj"))
def q_check_current2db(spark, sf):
    """H3."""
    return H.check_current2db(X.live_obj(spark, sf), X.hist_events(spark, sf))


@register("check_old2db", f"""
SELECT s.* FROM store_obj s WHERE s.deleted = {OPEN_SQL} AND NOT EXISTS (
  SELECT 1 FROM hist_events x WHERE x.row_id % 89 <> 0 AND x.type <> 'd' AND x.inode = s.inode
  AND x.dirname = s.dirname AND x.filename = s.filename AND x.created = s.created AND x.deleted = s.deleted)""",
          ("hist_events", "store_obj"))
def q_check_old2db(spark, sf):
    """H4 against a history with seeded missing rows."""
    h = X.hist_events(spark, sf).filter(F.col("row_id") % 89 != 0)
    return H.check_old2db(X.store_obj(spark, sf), h)


@register("check_old2current", f"""
SELECT s.* FROM store_obj s WHERE s.deleted = {OPEN_SQL} AND NOT EXISTS (
  SELECT 1 FROM live_obj l WHERE l.type <> 'd' AND l.dirname = s.dirname AND l.filename = s.filename)""",
          ("store_obj", "live_obj"))
def q_check_old2current(spark, sf):
    """H5."""
    return H.check_old2current(X.store_obj(spark, sf), X.live_obj(spark, sf))


@register("check_current2old", """
SELECT l.* FROM live_obj l WHERE l.type <> 'd' AND NOT EXISTS (
  SELECT 1 FROM store_obj s WHERE s.inode = l.inode AND s.dirname = l.dirname AND s.filename = l.filename)""",
          ("store_obj", "live_obj"))
def q_check_current2old(spark, sf):
    """H6."""
    return H.check_current2old(X.live_obj(spark, sf), X.store_obj(spark, sf))


@register("check_overlaps", """
SELECT * FROM (
  SELECT v.row_id, dirname, filename, v.created, v.deleted, list_min(list_transform(list_filter(p.spans, lambda s: s.b > v.created AND s.b < v.deleted AND s.e > v.created),
                                              lambda s: s.b)) AS next_created
  FROM hist_overlap v JOIN (SELECT dirname, filename, list(struct_pack(b := created, e := deleted)) AS spans FROM hist_overlap GROUP BY ALL) p
  USING (dirname, filename))
WHERE next_created IS NOT NULL""", ("hist_overlap",), headline=True)
def q_check_overlaps(spark, sf):
    """H7 on a history with seeded widened ends."""
    return H.check_overlaps(X.hist_overlap(spark, sf)).drop("inode")


@register("check_order", f"SELECT {HCOL} FROM hist_orders x WHERE x.created >= x.deleted", ("hist_orders",))
def q_check_order(spark, sf):
    """H8: same-day orders give empty intervals."""
    return H.check_order(X.hist_orders(spark, sf))


@register("check_dups_created", f"""
SELECT {HCOL} FROM hist_orders x
WINDOW w AS (PARTITION BY x.dirname, x.filename, x.created)
QUALIFY x.row_id < max(x.row_id) OVER w OR (x.freq = 0 AND count_if(x.freq <> 0) OVER w > 0)""", ("hist_orders",))
def q_check_dups_created(spark, sf):
    """H9: orders of one customer on one day."""
    return H.check_dups_created(X.hist_orders(spark, sf))


@register("check_dups_open", f"""
SELECT {HCOL}, (SELECT max_by(b.created, b.row_id) FROM hist_open_dups b
                WHERE b.deleted = {OPEN_SQL} AND b.dirname = x.dirname AND b.filename = x.filename) AS other_created
FROM hist_open_dups x WHERE x.deleted = {OPEN_SQL} AND EXISTS (
  SELECT 1 FROM hist_open_dups b WHERE b.deleted = {OPEN_SQL} AND b.dirname = x.dirname
  AND b.filename = x.filename AND x.row_id < b.row_id)""", ("hist_open_dups",))
def q_check_dups_open(spark, sf):
    """H10."""
    return H.check_dups_open(X.hist_open_dups(spark, sf))


REPAIR_SQL = f"""
WITH live2 AS (
  SELECT inode, type, dirname, filename FROM live_obj
  UNION ALL
  SELECT s.inode, 'f', s.dirname, s.filename FROM store_obj s WHERE s.deleted = {OPEN_SQL} AND NOT EXISTS (
    SELECT 1 FROM live_obj l WHERE l.type <> 'd' AND l.dirname = s.dirname AND l.filename = s.filename)),
ord AS (SELECT dirname, filename, created, deleted FROM hist_overlap WHERE created >= deleted),
store2 AS (SELECT s.* FROM store_obj s WHERE NOT EXISTS (
  SELECT 1 FROM ord o WHERE o.dirname = s.dirname AND o.filename = s.filename AND o.created = s.created
  AND o.deleted = s.deleted)),
h1 AS (SELECT h.* FROM hist_overlap h WHERE NOT (h.deleted = {OPEN_SQL} AND NOT EXISTS (
  SELECT 1 FROM live2 l WHERE l.dirname = h.dirname AND l.filename = h.filename))),
h2 AS (SELECT h.* FROM h1 h WHERE NOT (h.type <> 'd' AND NOT EXISTS (
  SELECT 1 FROM store2 s WHERE s.dirname = h.dirname AND s.filename = h.filename AND s.created = h.created
  AND s.deleted = h.deleted))),
h3 AS (SELECT * FROM h2 QUALIFY row_number() OVER (
  PARTITION BY dirname, filename, created ORDER BY freq <> 0 DESC, row_id DESC) = 1),
ov AS (SELECT row_id, nc FROM (
  SELECT v.row_id, list_min(list_transform(list_filter(p.spans, lambda s: s.b > v.created AND s.b < v.deleted AND s.e > v.created),
                                              lambda s: s.b)) AS nc
  FROM h3 v JOIN (SELECT dirname, filename, list(struct_pack(b := created, e := deleted)) AS spans FROM h3 GROUP BY ALL) p
  USING (dirname, filename))
  WHERE nc IS NOT NULL),
h4 AS (SELECT h.row_id, h.inode, h.type, h.dirname, h.filename, h.created, coalesce(ov.nc, h.deleted) AS deleted,
              CASE WHEN ov.nc IS NOT NULL THEN {freq_sql('h.created', 'ov.nc')} ELSE h.freq END AS freq
       FROM h3 h LEFT JOIN ov ON h.row_id = ov.row_id),
cut AS (SELECT h.dirname, h.filename, h.created, h.deleted, ov.nc FROM h3 h JOIN ov ON h.row_id = ov.row_id),
store3 AS (SELECT s.inode, s.type, s.dirname, s.filename, s.created, coalesce(c.nc, s.deleted) AS deleted
           FROM store2 s LEFT JOIN cut c ON c.dirname = s.dirname AND c.filename = s.filename
            AND c.created = s.created AND c.deleted = s.deleted)
SELECT inode, type, dirname, filename, created, deleted, freq FROM h4
UNION ALL
SELECT s.inode, 'f', s.dirname, s.filename, s.created, s.deleted, {freq_sql('s.created', 's.deleted')}
FROM store3 s WHERE s.deleted = {OPEN_SQL} AND NOT EXISTS (
  SELECT 1 FROM h4 h WHERE h.type <> 'd' AND h.inode = s.inode AND h.dirname = s.dirname
  AND h.filename = s.filename AND h.created = s.created AND h.deleted = s.deleted)"""


@register("repair_all", REPAIR_SQL, ("hist_overlap", "live_obj", "store_obj"), headline=True)
def q_repair_all(spark, sf):
    """All repairs on the seeded history in dependency order (row ids of inserted rows are hashes)."""
    r = H.repair_all(X.hist_overlap(spark, sf), X.live_obj(spark, sf), X.store_obj(spark, sf))
    return history_columns(r["history"]).drop("row_id")


def _summary_sql() -> str:
    """The statements of the ten checks, all over one faulty history."""
    rows, item = [], {"row_id": "CAST(row_id AS VARCHAR)", "path": "CAST(inode AS VARCHAR) || ' ' || dirname || filename"}
    for check, (query, key) in SUMMARY.items():
        text = BODY[query].replace("x.row_id % 89 <> 0 AND ", "")
        for name in ("hist_events", "hist_overlap", "hist_orders", "hist_open_dups"):
            text = text.replace(name, "hist_faults")
        rows.append(f"SELECT '{check}' AS \"check\", {item[key]} AS item FROM ({text})")
    return f"""
WITH res AS ({' UNION ALL '.join(rows)}),
cnt AS (SELECT "check", count(*) AS n_rows FROM res GROUP BY 1)
SELECT r."check", r.item, r.rank, c.n_rows FROM (
  SELECT "check", item, row_number() OVER (PARTITION BY "check" ORDER BY item) AS rank FROM res) r
JOIN cnt c ON r."check" = c."check" WHERE r.rank <= 10"""


SUMMARY = {  # check name: (registered query, what names a row)
    "old2current": ("check_old2current", "path"), "db_order": ("check_order", "row_id"),
    "db2current": ("check_db2current", "row_id"), "db2old": ("check_db2old", "row_id"),
    "db_dups_created": ("check_dups_created", "row_id"), "db_overlaps": ("check_overlaps", "row_id"),
    "old2db": ("check_old2db", "path"), "current2db": ("check_current2db", "path"),
    "current2old": ("check_current2old", "path"), "db_dups_freq0": ("check_dups_open", "row_id")}


@register("check_summary", _summary_sql(), ("hist_faults", "live_obj", "store_obj"))
def q_check_summary(spark, sf):
    """Rows of each of the ten checks and the first ten of each."""
    found = H.all_checks(X.hist_faults(spark, sf), X.live_obj(spark, sf), X.store_obj(spark, sf))
    path = F.concat(F.col("inode").cast("string"), F.lit(" "), "dirname", "filename")
    res = {n: df.select((F.col("row_id").cast("string") if SUMMARY[n][1] == "row_id" else path).alias("item")) for n, df in found.items()}
    return R.check_summary(res).select("check", "item", F.col("rank").cast("long").alias("rank"), "n_rows")

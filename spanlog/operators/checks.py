"""Integrity checks among three inventories and their repairs.

Inventories: ``h`` the history, ``live`` the live tree (inode, type, dirname,
filename) and ``store`` the version objects (inode, type, dirname, filename,
created, deleted).  Every check returns the offending rows; ``repair_*``
return the corrected table.  All checks are anti/semi joins or grouped
aggregates joined back — none compares all pairs of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import freq_class
from ..model import KEY, VERSION, closed_versions, history_columns, is_open, open_versions
from ..plans.ordered import keyed_scan
from ..session import reliable_checkpoint

VKEY = KEY + ["created", "deleted"]


def check_db2current(h: DataFrame, live: DataFrame) -> DataFrame:
    """H1: open versions with no live object at that path."""
    return open_versions(h).join(live.select(*KEY), KEY, "left_anti")


def repair_db2current(h: DataFrame, live: DataFrame) -> DataFrame:
    """Open versions stay where a live object is; closed versions are not touched (nor shuffled)."""
    kept = open_versions(h).join(live.select(*KEY), KEY, "left_semi")
    return history_columns(closed_versions(h)).unionByName(history_columns(kept))


def check_db2old(h: DataFrame, store: DataFrame) -> DataFrame:
    """H2: non-directory versions with no store object of that exact name."""
    return h.filter(F.col("type") != "d").join(store.select(*VKEY), VKEY, "left_anti")


def repair_db2old(h: DataFrame, store: DataFrame) -> DataFrame:
    """Directory versions stay; others stay where their store object is."""
    checked = F.coalesce(F.col("type") != "d", F.lit(False))
    kept = h.filter(checked).join(store.select(*VKEY), VKEY, "left_semi")
    return history_columns(h.filter(~checked)).unionByName(history_columns(kept))


def check_current2db(live: DataFrame, h: DataFrame) -> DataFrame:
    """H3: live objects with no open version of the same inode and path."""
    o = open_versions(h).select("inode", *KEY)
    return live.join(o, ["inode"] + KEY, "left_anti")


def check_old2db(store: DataFrame, h: DataFrame) -> DataFrame:
    """H4: open store objects with no non-directory version equal on path, times and inode."""
    hv = h.filter(F.col("type") != "d").select("inode", *VKEY)
    return store.filter(is_open("deleted")).join(hv, ["inode"] + VKEY, "left_anti")


def repair_old2db(store: DataFrame, h: DataFrame) -> DataFrame:
    """Insert the missing versions (as files; the reference leaves the type empty)."""
    miss = check_old2db(store, h)
    rows = miss.select(F.xxhash64("dirname", "filename", "created", "inode").alias("row_id"), "inode",
                       F.lit("f").alias("type"), *VKEY, freq_class("created", "deleted").alias("freq"))
    return history_columns(h).unionByName(rows)


def check_old2current(store: DataFrame, live: DataFrame) -> DataFrame:
    """H5: open store objects whose path is not a live file."""
    lf = live.filter(F.col("type") != "d").select(*KEY)
    return store.filter(is_open("deleted")).join(lf, KEY, "left_anti")


def repair_old2current(store: DataFrame, live: DataFrame) -> DataFrame:
    """Re-create the missing live files from their open store objects."""
    miss = check_old2current(store, live)
    return live.unionByName(miss.select("inode", F.lit("f").alias("type"), *KEY))


def check_current2old(live: DataFrame, store: DataFrame) -> DataFrame:
    """H6: live non-directory objects with no store version of the same inode."""
    return live.filter(F.col("type") != "d").join(store.select("inode", *KEY), ["inode"] + KEY, "left_anti")


def check_overlaps(h: DataFrame) -> DataFrame:
    """H7: versions overlapped by a later-starting version of the same path.

    Returns each such version with ``next_created`` = the smallest overlapping start. A version overlaps one that starts
    at *c* if it starts after *c* and ends after *c*, that is if the earlier of its two times is after *c* (which differs from its
    start for inverted versions, H8 faults, only). So the smallest such start is a running minimum of the starts, in
    descending order of the earlier times: one range-partitioned scan, no pairs, whatever the number of versions of a path.
    """
    a = h.select(*VERSION)
    # starts, merged with the rows asking (they carry their whole identity through the scan); rows ask before starts at equal time
    ask = a.select(*VERSION, (-F.unix_micros("created")).alias("_neg"), F.lit(0).alias("_side"),
                   F.lit(None).cast("timestamp").alias("_b"))
    ends = a.filter(F.col("created").isNotNull() & F.col("deleted").isNotNull())
    starts = ends.select(*VERSION, (-F.unix_micros(F.least("created", "deleted"))).alias("_neg"), F.lit(1).alias("_side"),
                         F.col("created").alias("_b"))
    s = keyed_scan(ask.unionByName(starts), KEY, ["_neg", "_side", "row_id", "inode", "deleted"], cummin=["_b"])
    j = s.filter((F.col("_side") == 0) & (F.col("cummin__b") < F.col("deleted")))
    return j.select("row_id", "inode", *KEY, "created", "deleted", F.col("cummin__b").alias("next_created"))


def repair_overlaps(h: DataFrame, overlaps: DataFrame | None = None) -> DataFrame:
    """Cut an overlapped version at the next start; class recomputed."""
    o = (overlaps if overlaps is not None else check_overlaps(h)).select(*VERSION, "next_created")
    j = h.join(o, VERSION, "left")
    j = j.withColumn("deleted", F.coalesce("next_created", "deleted"))
    j = j.withColumn("freq", F.when(F.col("next_created").isNotNull(), freq_class("created", "deleted"))
                     .otherwise(F.col("freq")))
    return history_columns(j)


def check_order(h: DataFrame) -> DataFrame:
    """H8: versions that end before (or when) they start."""
    return h.filter(F.col("created") >= F.col("deleted"))


def check_dups_created(h: DataFrame) -> DataFrame:
    """H9: versions with a twin on (path, created) that lose to it.

    A row loses if a twin has a larger row id, or if it is open while a twin is
    closed.  One aggregate per (path, created) joined back (no self-join).
    """
    g = h.groupBy(*KEY, "created").agg(
        F.max("row_id").alias("_mx"), F.count(F.lit(1)).alias("_n"),
        F.count(F.when(F.col("freq") != 0, 1)).alias("_closed"))
    j = h.join(g.filter(F.col("_n") > 1), KEY + ["created"])
    lose = (F.col("row_id") < F.col("_mx")) | ((F.col("freq") == 0) & (F.col("_closed") > 0))
    return history_columns(j.filter(lose))


def repair_dups_created(h: DataFrame) -> DataFrame:
    """One version per (path, start) stays: a closed one if there is any, then that with the largest row id.

    The reference deletes every row that has a better twin in either sense, so of a closed row and an open one with a
    larger id nothing is left; here each (path, start) keeps one. A grouped maximum: no group is collected."""
    rest = ["row_id", "inode", "type", "deleted", "freq"]
    best = h.groupBy(*KEY, "created").agg(F.max(F.struct((F.col("freq") != 0).alias("closed"), *rest)).alias("_v"))
    return history_columns(best.select(*KEY, "created", *[F.col(f"_v.{c}").alias(c) for c in rest]))


def check_dups_open(h: DataFrame) -> DataFrame:
    """Open versions that share their path with a newer open version.

    Each is reported once with the start of the newest open version of the
    path (one aggregate per path; no pairs are formed).
    """
    o = open_versions(h)
    g = o.groupBy(*KEY).agg(F.max_by(F.struct("row_id", "created"), "row_id").alias("_last"))
    j = o.join(g, KEY).filter(F.col("row_id") < F.col("_last.row_id"))
    return j.select(*history_columns(o).columns, F.col("_last.created").alias("other_created"))


def repair_all(h: DataFrame, live: DataFrame, store: DataFrame) -> dict[str, DataFrame]:
    """Repairs in dependency order; returns the repaired inventories and the reports.

    old2current -> order -> db2current -> db2old -> dups_created -> overlaps -> old2db,
    then the report-only checks current2db, current2old and dups_open.
    """
    # every stage reads the previous one several times: stages are materialised in the
    # shared folder so that plans stay flat (and a lost executor recomputes one stage only)
    cp = reliable_checkpoint
    live2 = cp(repair_old2current(store, live))
    order = check_order(h)
    store2 = cp(store.join(order.select(*VKEY), VKEY, "left_anti"))
    h1 = cp(repair_db2current(h, live2))
    h2 = cp(repair_db2old(h1, store2))
    h3 = cp(repair_dups_created(h2))
    ov = cp(check_overlaps(h3))
    cut = ov.select(*KEY, "created", "deleted", "next_created")
    h4 = repair_overlaps(h3, ov)
    # the store object of a cut version is renamed to its new end
    st = store2.join(cut, VKEY, "left")
    store3 = st.withColumn("deleted", F.coalesce("next_created", "deleted")).drop("next_created")
    h5 = repair_old2db(store3, h4)
    return {
        "history": h5, "live": live2, "store": store3,
        "current2db": check_current2db(live2, h5),
        "current2old": check_current2old(live2, store3),
        "dups_open": check_dups_open(h5),
    }


def all_checks(h: DataFrame, live: DataFrame, store: DataFrame) -> dict[str, DataFrame]:
    """Every check, keyed by the reference's check names (input to the summary report)."""
    return {
        "old2current": check_old2current(store, live),
        "db_order": check_order(h),
        "db2current": check_db2current(h, live),
        "db2old": check_db2old(h, store),
        "db_dups_created": check_dups_created(h),
        "db_overlaps": check_overlaps(h),
        "old2db": check_old2db(store, h),
        "current2db": check_current2db(live, h),
        "current2old": check_current2old(live, store),
        "db_dups_freq0": check_dups_open(h),
    }


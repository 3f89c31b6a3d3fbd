"""Snapshot diff and upkeep of the history (slowly changing dimension, type 2).

A listing (inventory) of the live tree is compared with the open versions:
listing rows without an equal open version are *new*, open versions missing
from the listing are *old*.  Old paths are closed at time ``t`` (class
recomputed), then new rows are inserted as open versions.  Every step is a
join on the 4-column row identity or the 2-column key; nothing is updated in
place: the result is a new DataFrame to be written to a new location.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import freq_class
from ..functions.paths import full_path
from ..plans.ordered import keyed_scan
from ..plans.pointers import reached
from ..model import KEY, ROW4, closed_versions, history_columns, open_ts, open_versions, row_id_of, ts
from ..session import reliable_checkpoint


def scope_prefix(df: DataFrame, directory: str | None) -> DataFrame:
    """Restrict to the subtree ``./dir/`` (the subtree's own entry is outside)."""
    if not directory:
        return df
    return df.filter(F.col("dirname").startswith(f"./{directory.strip('/')}/"))


def diff_new(inv: DataFrame, h: DataFrame, scope: str | None = None) -> DataFrame:
    """B1: listing rows with no open version equal on (inode, type, dirname, filename)."""
    return scope_prefix(inv, scope).select(*ROW4).join(
        scope_prefix(open_versions(h), scope).select(*ROW4), ROW4, "left_anti")


def diff_old(inv: DataFrame, h: DataFrame, scope: str | None = None) -> DataFrame:
    """B2: open versions with no equal listing row."""
    return scope_prefix(open_versions(h), scope).join(
        scope_prefix(inv, scope).select(*ROW4), ROW4, "left_anti")


def diff_classify(inv: DataFrame, h: DataFrame, scope: str | None = None) -> DataFrame:
    """Per path added / removed / replaced / unchanged (full outer join on the key)."""
    a = scope_prefix(inv, scope).select(*KEY, F.col("inode").alias("new_inode"), F.col("type").alias("new_type"))
    b = scope_prefix(open_versions(h), scope).select(*KEY, F.col("inode").alias("old_inode"),
                                                     F.col("type").alias("old_type"))
    j = a.join(b, KEY, "full")
    same = F.col("new_inode").eqNullSafe(F.col("old_inode")) & F.col("new_type").eqNullSafe(F.col("old_type"))
    status = (F.when(F.col("old_inode").isNull() & F.col("old_type").isNull(), F.lit("added"))
              .when(F.col("new_inode").isNull() & F.col("new_type").isNull(), F.lit("removed"))
              .when(same, F.lit("unchanged"))
              .otherwise(F.lit("replaced")))
    return j.withColumn("status", status)


def close_versions(h: DataFrame, old: DataFrame, t, max_freq: int = 8640) -> DataFrame:
    """Set ``deleted = t`` on open versions whose path is in ``old``; class recomputed.

    Only open versions are joined with the distinct old keys; closed ones pass by unshuffled.
    """
    keys = old.select(*KEY).distinct().withColumn("_close", F.lit(True))
    j = open_versions(h).join(keys, KEY, "left")
    j = j.withColumn("_hit", F.col("_close").isNotNull())
    j = j.withColumn("deleted", F.when(F.col("_hit"), ts(t)).otherwise(F.col("deleted")))
    j = j.withColumn("freq", F.when(F.col("_hit"), freq_class("created", "deleted", max_freq))
                     .otherwise(F.col("freq")))
    return history_columns(closed_versions(h)).unionByName(history_columns(j))


def insert_versions(h: DataFrame, new: DataFrame, t) -> DataFrame:
    """Append new rows as open versions created at ``t``."""
    t = ts(t)
    rows = new.select(
        row_id_of("dirname", "filename", "inode", "type", t).alias("row_id"), *ROW4,
        t.alias("created"), open_ts().alias("deleted"), F.lit(0).cast("long").alias("freq"))
    return history_columns(h).unionByName(rows)


def quarantine_conflicts(new: DataFrame, h_closed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split new rows into (insertable, quarantined).

    Quarantined: a row whose path still has an open version after closing (the
    listing held the path twice, one copy unchanged), and all but one row of a
    path listed twice among the new rows (the smallest (inode, type) stays).
    Grouping instead of a window keeps a heavily repeated path off one task.
    """
    still_open = open_versions(h_closed).select(*KEY).distinct()
    conflict = new.join(still_open, KEY, "left_semi")
    rest = new.join(still_open, KEY, "left_anti")
    keep = rest.groupBy(*KEY).agg(F.min(F.struct("inode", "type")).alias("_k"))
    keep = keep.select(*KEY, F.col("_k.inode").alias("inode"), F.col("_k.type").alias("type"))
    dups = rest.join(keep, ROW4, "left_anti")
    return keep, conflict.unionByName(dups)


@dataclass
class SnapshotResult:
    history: DataFrame
    new: DataFrame
    old: DataFrame
    bad: DataFrame


def apply_snapshot(h: DataFrame, inv: DataFrame, t, scope: str | None = None,
                   max_freq: int = 8640) -> SnapshotResult:
    """Diff, close old paths, quarantine conflicts, insert the rest (in that order).

    ``bad`` carries ``created = t`` and ``deleted`` open, like the rows it stands for.
    """
    new = diff_new(inv, h, scope)
    old = diff_old(inv, h, scope)
    # closing, conflicts and inserts concern the open versions only; closed ones are appended as they are
    still = close_versions(open_versions(h), old, t, max_freq)
    ins, bad = quarantine_conflicts(new, still)
    h2 = history_columns(closed_versions(h)).unionByName(insert_versions(still, ins, t))
    bad = bad.select(*ROW4, ts(t).alias("created"), open_ts().alias("deleted"))
    return SnapshotResult(h2, new, old, bad)


def type_changes(h: DataFrame) -> DataFrame:
    """Paths seen with more than one type (file <-> directory)."""
    return (h.groupBy(*KEY).agg(F.min("type").alias("type_a"), F.max("type").alias("type_b"),
                                F.count(F.lit(1)).alias("n_versions"))
            .filter(F.col("type_a") != F.col("type_b")))


def assert_open_unique(h: DataFrame) -> DataFrame:
    """Paths with more than one open version (must be empty)."""
    return (open_versions(h).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_open"))
            .filter(F.col("n_open") > 1))


def changed_paths(new: DataFrame, old: DataFrame) -> DataFrame:
    """Non-directory outputs of a diff; old ones with their store path prefix."""
    from ..model import fmt_time
    a = new.filter(F.col("type") != "d").select(F.lit("new").alias("kind"), full_path().alias("path"))
    b = old.filter(F.col("type") != "d").select(
        F.lit("old").alias("kind"), F.concat(full_path(), F.lit("/"), fmt_time("created")).alias("path"))
    return a.unionByName(b)


def _one_per_path(s: DataFrame) -> DataFrame:
    """Listing rows (t, idx, ROW4) with one version per path and time, chosen as B6 and B9 do.

    A repeated row counts once. Of different rows of a path at one time the version open since the time before stays, or
    else the smallest (inode, type) is taken. Only paths with such a clash need a choice (``_chosen``); all others pass through."""
    g = s.groupBy(*KEY, "idx", "t").agg(F.array_sort(F.collect_set(F.struct("inode", "type"))).alias("_v"))
    g = reliable_checkpoint(g)  # read three times
    clash = g.filter(F.size("_v") > 1).select(*KEY).distinct()
    one = g.join(clash, KEY, "left_anti").select("t", "idx", *KEY, F.col("_v")[0].alias("_c"))
    many = reliable_checkpoint(g.join(clash, KEY, "left_semi"))
    if not many.isEmpty():
        one = one.unionByName(_chosen(many))
    return one.select("t", "idx", F.col("_c.inode").alias("inode"), F.col("_c.type").alias("type"), *KEY)


def _chosen(g: DataFrame) -> DataFrame:
    """One version per path and time of listings (KEY, idx, t, _v: the versions listed), whatever their number of times.

    A version taken at a time stays as long as the listings after it go on holding it; at the first one that does not, the
    smallest is taken anew. So each time has one successor at which the choice is made again, if it is made there at all, and the
    times at which it is are reached from those with no listing of the path just before (``pointers.reached``)."""
    listed = keyed_scan(g, KEY, ["idx"], lag=["idx"])
    heads = listed.where(F.col("lag_idx").isNull() | (F.col("lag_idx") != F.col("idx") - 1)).select(*KEY, "idx")
    # the end of every version's stretch of consecutive listings, carried back to its times
    x = g.select(*KEY, "idx", (-F.col("idx")).alias("_back"), F.posexplode("_v").alias("_pos", "_c"))
    x = keyed_scan(x, [*KEY, "_c"], ["_back"], lag=["idx"], keep_ranges=True)
    last = F.col("lag_idx").isNull() | (F.col("lag_idx") != F.col("idx") + 1)
    x = keyed_scan(x.withColumn("_end", F.when(last, F.col("idx"))).drop("lag_idx"), [*KEY, "_c"], ["_back"], ffill=["_end"])
    links = x.where("_pos = 0").select(*KEY, "idx", (F.col("ffill__end") + 1).alias("_to"))
    links = links.join(g.select(*KEY, F.col("idx").alias("_to")), [*KEY, "_to"])
    anew = reached(heads, links, KEY, "idx", "_to").withColumn("_anew", F.lit(True))
    taken = g.join(anew, [*KEY, "idx"], "left").withColumn("_c", F.when(F.col("_anew"), F.col("_v")[0])).drop("_anew", "_v")
    return keyed_scan(taken, KEY, ["idx"], ffill=["_c"]).select("t", "idx", *KEY, F.col("ffill__c").alias("_c"))


def series_to_history(snaps: DataFrame, times: DataFrame, max_freq: int = 8640) -> DataFrame:
    """Many snapshots (t, inode, type, dirname, filename) to history in one job; equals B6 snapshot after snapshot.

    Snapshot times are a separate input so that an empty snapshot still closes
    versions.  They get a dense index (one row per snapshot; how it is joined is left to
    the optimizer).  A version present in consecutive snapshots is one interval
    (gaps-and-islands: index minus rank within the version); it ends at the
    first snapshot it is absent from, or stays open.  Rows of one path at one
    time are settled first (``_one_per_path``).
    """
    w = Window.orderBy("t")
    idx = times.select("t").distinct().withColumn("idx", F.row_number().over(w).cast("long"))
    idx = idx.withColumn("next_t", F.lead("t").over(w))
    s = _one_per_path(snaps.select("t", *ROW4).join(idx.select("t", "idx"), "t"))
    # rank within the version by a range-partitioned running count (a key may be hot)
    s = keyed_scan(s.withColumn("_one", F.lit(1).cast("long")), ROW4, ["idx"], cumsum=["_one"])
    s = s.withColumn("_isl", F.col("idx") - F.col("cumsum__one"))
    g = s.groupBy(*ROW4, "_isl").agg(F.min("t").alias("created"), F.max("idx").alias("_last"))
    g = g.join(idx.select(F.col("idx").alias("_last"), "next_t"), "_last")
    g = g.withColumn("deleted", F.coalesce(F.col("next_t"), open_ts()))
    out = g.select(row_id_of("dirname", "filename", "inode", "type", "created").alias("row_id"),
                   *ROW4, "created", "deleted")
    return out.withColumn("freq", freq_class("created", "deleted", max_freq))


def fold_snapshots(h: DataFrame, listings: list[tuple[str, DataFrame]]) -> DataFrame:
    """Apply B6 snapshot after snapshot (the reference's loop); used as a test oracle for B11."""
    for t, inv in listings:
        h = apply_snapshot(h, inv, t).history
    return h

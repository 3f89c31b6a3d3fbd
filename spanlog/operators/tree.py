"""Hierarchy: directories derived from paths, empty directories, rebuild from the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import freq_class
from ..functions.paths import ancestor_dirs, breadcrumbs, normalize_path, prefix_dirs, root_of
from ..model import KEY, ROW4, history_columns, is_open, open_ts
from ..session import reliable_checkpoint


def rollup_ancestors(h: DataFrame) -> DataFrame:
    """One directory version per ancestor of any row: min start, max end; inode 0.

    Rows are grouped by directory first (partial aggregation), so the explode of
    ancestors runs once per directory, not once per version.
    """
    g = h.groupBy("dirname").agg(F.min("created").alias("c"), F.max("deleted").alias("d"))
    x = g.select(F.explode(ancestor_dirs("dirname")).alias("a"), "c", "d")
    r = x.groupBy(F.col("a.parent").alias("dirname"), F.col("a.name").alias("filename")).agg(
        F.min("c").alias("created"), F.max("d").alias("deleted"))
    return r.select(F.lit(0).cast("long").alias("inode"), F.lit("d").alias("type"), "dirname", "filename",
                    "created", "deleted")


def min_created(h: DataFrame) -> DataFrame:
    """I3."""
    return h.agg(F.min("created").alias("min_created"))


def upsert_dir_ids(h: DataFrame, live_dirs: DataFrame) -> DataFrame:
    """Live directories update the id of their directory version and reopen it; unknown
    directories are inserted as open since the oldest start of the history.

    ``min_created`` enters as a scalar subquery (one value computed by Spark).
    """
    first = h.agg(F.min("created")).scalar()
    d = h.filter(F.col("type") == "d")
    rest = h.filter(F.col("type") != "d")
    live = live_dirs.select(*KEY, F.col("inode").alias("_live_inode"))
    j = d.join(live, KEY, "full")
    matched = F.col("_live_inode").isNotNull()
    out = j.select(
        F.coalesce("row_id", F.xxhash64(*KEY)).alias("row_id"),
        F.when(matched, F.col("_live_inode")).otherwise(F.col("inode")).alias("inode"),
        F.lit("d").alias("type"), *KEY,
        F.coalesce(F.col("created"), first).alias("created"),
        F.when(matched, open_ts()).otherwise(F.col("deleted")).alias("deleted"))
    out = out.withColumn("freq", freq_class("created", "deleted"))
    return history_columns(rest).unionByName(out)


def root_names(df: DataFrame) -> DataFrame:
    """I4."""
    return df.select("inode", root_of("dirname").alias("root"))


def path_breadcrumbs(df: DataFrame, path_col: str = "path") -> DataFrame:
    """(inode, depth, crumb) for all prefixes of each path."""
    return df.select("inode", F.posexplode(breadcrumbs(path_col)).alias("pos", "crumb")).select(
        "inode", (F.col("pos") + 1).alias("depth"), "crumb")


def empty_dirs(inv: DataFrame) -> DataFrame:
    """Directory rows with no file at any depth below them."""
    used = (inv.filter(F.col("type") != "d").select(F.expr("substring(dirname, 3)").alias("rel")).distinct()
            .select(F.explode(prefix_dirs("rel")).alias("p")).distinct()
            .select(F.concat(F.lit("./"), "p").alias("p")))
    dirs = inv.filter(F.col("type") == "d").withColumn("p", F.concat("dirname", "filename", F.lit("/")))
    return dirs.join(used, "p", "left_anti").drop("p")


def normalize_paths(df: DataFrame, path_col: str = "path") -> DataFrame:
    """(dirname, filename) of raw paths: ``./`` prefix, no trailing '/'."""
    d, f = normalize_path(path_col)
    return df.select("*", d.alias("dirname"), f.alias("filename"))


def rebuild_history(store: DataFrame, live_dirs: DataFrame) -> DataFrame:
    """A10: history re-created from store objects: files, their ancestor directories, live dir ids."""
    files = store.select(F.xxhash64(*KEY, "created", "inode").alias("row_id"), *ROW4, "created", "deleted")
    # the parsed store is read three times below: it is materialised once in the shared folder
    files = reliable_checkpoint(files.withColumn("freq", freq_class("created", "deleted")))
    dirs = rollup_ancestors(files)
    dirs = dirs.select(F.xxhash64(*KEY).alias("row_id"), *dirs.columns).withColumn(
        "freq", freq_class("created", "deleted"))
    return upsert_dir_ids(files.unionByName(dirs), live_dirs)


def rebuild_live(store: DataFrame) -> DataFrame:
    """The open store objects give the live listing back."""
    return store.filter(is_open("deleted")).select(*ROW4)

"""Counts, top-k and summary reports over a history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import SECONDS_PER_MONTH, int_div
from ..functions.paths import root_of
from ..functions.times import days_between, epoch
from ..model import ts
from ..plans.ordered import keyed_scan


def count_versions(h: DataFrame) -> DataFrame:
    """E1."""
    return h.agg(F.count(F.lit(1)).alias("n_versions"))


def count_per_root(h: DataFrame) -> DataFrame:
    """Versions per first path component; rows of the root directory excluded."""
    return (h.filter(F.col("dirname") != "./").groupBy(root_of("dirname").alias("root"))
            .agg(F.count(F.lit(1)).alias("n_versions")))


def most_changed(h: DataFrame, k: int = 10) -> DataFrame:
    """Top-k paths by number of versions (ties by path)."""
    return (h.groupBy("dirname", "filename").agg(F.count(F.lit(1)).alias("num"))
            .orderBy(F.desc("num"), "dirname", "filename").limit(k))


def oldest_deleted_per_class(h: DataFrame) -> DataFrame:
    """min(deleted) per class of closed versions."""
    return h.filter(F.col("freq") != 0).groupBy("freq").agg(F.min("deleted").alias("oldest"))


def last_activity(h: DataFrame, roots: DataFrame, now) -> DataFrame:
    """E5: per root the newest start of an open version and the newest end of a closed one.

    One pass: conditional maxima per root, then two rows per root.  Roots come
    from the live listing; a root without versions gets NULLs.
    """
    now = ts(now)
    agg = (h.select(root_of("dirname").alias("root"), "created", "deleted", "freq")
           .filter(F.col("dirname") != "./")
           .groupBy("root")
           .agg(F.max(F.when(F.col("freq") == 0, F.col("created"))).alias("c"),
                F.max(F.when(F.col("freq") != 0, F.col("deleted"))).alias("d")))
    x = roots.select("root").distinct().join(agg, "root", "left")
    x = x.select("root", F.expr("stack(2, 'created', c, 'deleted', d) AS (direction, last_backup)"))
    return x.withColumn("days_ago", F.round(days_between(now, F.col("last_backup")), 2))


def latest_in_dir(h: DataFrame, like: str, now) -> DataFrame:
    """Newest open version per directory matching a LIKE pattern (ties by name)."""
    now = ts(now)
    x = h.filter((F.col("freq") == 0) & F.col("dirname").like(like))
    g = x.groupBy("dirname").agg(
        F.max_by(F.col("filename"), F.struct(F.col("created"), F.col("filename"))).alias("filename"),
        F.max("created").alias("created"))
    return g.withColumn("days_ago", F.round(days_between(now, F.col("created")), 2))


def class_age(h: DataFrame, now, max_freq: int = 8640) -> DataFrame:
    """Oldest closed version per class and its age in class units (integer, then 2 decimals)."""
    now = ts(now)
    g = (h.filter((F.col("freq") != 0) & (F.col("freq") <= max_freq))
         .groupBy("freq").agg(F.min("deleted").alias("oldest")))
    age = int_div((epoch(now) - epoch(F.col("oldest"))) * F.col("freq"), F.lit(SECONDS_PER_MONTH))
    return g.withColumn("age", F.round(age.cast("double"), 2))


def quarantine_report(bad: DataFrame) -> DataFrame:
    """Conflicts summary (rows exist only when there are conflicts)."""
    return (bad.agg(F.count(F.lit(1)).alias("n_bad"),
                    F.countDistinct("dirname", "filename").alias("n_paths"),
                    F.min("created").alias("first_created"))
            .filter(F.col("n_bad") > 0))


def usage_per_root(live: DataFrame, store: DataFrame) -> DataFrame:
    """Bytes per root in the live tree and the store, plus a total row ``.``.

    Both inventories are tagged and aggregated in one shuffle with a rollup.
    """
    u = (live.select(root_of("dirname").alias("root"), F.col("size").alias("live_b"),
                     F.lit(None).cast("long").alias("store_b"))
         .unionByName(store.select(root_of("dirname").alias("root"), F.lit(None).cast("long").alias("live_b"),
                                   F.col("size").alias("store_b"))))
    r = u.rollup("root").agg(F.sum("live_b").cast("long").alias("live_bytes"),
                             F.sum("store_b").cast("long").alias("store_bytes"),
                             F.grouping("root").alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit(".")).otherwise(F.col("root")).alias("name"),
                    "live_bytes", "store_bytes")


# Names of protection sidecar files.
SIDECAR_REGEX = r"(\.bak|\.par2|\.vol.*)$"


def protection_bytes(files: DataFrame, name: str = "objname") -> DataFrame:
    """Total bytes of protection sidecars."""
    return files.filter(F.col(name).rlike(SIDECAR_REGEX)).agg(F.sum("size").cast("long").alias("sidecar_bytes"))


def protection_coverage(eligible: DataFrame, manifest: DataFrame) -> DataFrame:
    """Eligible versions, how many are secured, integer percent (NULL on an empty set)."""
    m = manifest.select("dirname", "filename", "created").distinct().withColumn("_secured", F.lit(1))
    j = eligible.join(m, ["dirname", "filename", "created"], "left")
    g = j.agg(F.count(F.lit(1)).alias("total"), F.count("_secured").alias("secured"))
    return g.withColumn("pct", int_div(F.col("secured") * 100, F.nullif(F.col("total"), F.lit(0))))


def protection_progress(eligible: DataFrame, manifest: DataFrame, every: int = 100) -> DataFrame:
    """E11 while it runs: after each ``every`` versions, by path, how many were looked at (``checked``) and how many of them are secured.

    The counts are running sums over ranges of the order, so no task walks through all versions."""
    m = manifest.select("dirname", "filename", "created").distinct().withColumn("_secured", F.lit(1).cast("long"))
    j = eligible.select("dirname", "filename", "created", "row_id", "inode").join(m, ["dirname", "filename", "created"], "left")
    j = j.withColumn("_secured", F.coalesce("_secured", F.lit(0).cast("long"))).withColumn("_one", F.lit(1).cast("long"))
    s = keyed_scan(j, [], ["dirname", "filename", "created", "row_id", "inode"], cumsum=["_one", "_secured"])
    return s.filter(F.col("cumsum__one") % every == 0).select(
        F.col("cumsum__one").alias("checked"), F.col("cumsum__secured").alias("secured"))


def dedup_counters(d: DataFrame) -> DataFrame:
    """Duplicate rows and groups of a dedup work table."""
    return d.agg(F.count(F.lit(1)).alias("total_dups"),
                 F.countDistinct("dirname", "filename", "span_from", "span_to").alias("total_groups"))


def check_summary(results: dict[str, DataFrame], show: int = 10, key: str = "item") -> DataFrame:
    """Per check the number of offending rows and the first ``show`` of them."""
    from pyspark.sql import Window
    parts = None
    for name, df in results.items():
        x = df.select(F.lit(name).alias("check"), F.col(key).cast("string").alias("item"))
        parts = x if parts is None else parts.unionByName(x)
    counts = parts.groupBy("check").agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy("check").orderBy("item")
    top = parts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= show)
    return top.join(counts, "check")

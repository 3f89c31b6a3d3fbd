"""Retention: which closed versions to delete, in which order, until enough space is free."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import full_path
from ..functions.times import epoch
from ..model import fmt_time, ts
from ..plans.ordered import global_exclusive_cumsum


def retention_score(h: DataFrame, now) -> DataFrame:
    """closed versions with ``age = freq * (now + 1 - deleted)`` seconds (largest first)."""
    now = ts(now)
    x = h.filter(F.col("freq") != 0)
    x = x.withColumn("age", F.col("freq") * (epoch(now) + 1 - epoch("deleted")))
    return x.withColumn("store_prefix", F.concat(full_path(), F.lit("/"), fmt_time("created")))


def hold_cutoff(now, months: int, days: int, hours: int) -> dict[int, Column]:
    """Versions of a class with rolling snapshots are held if they ended at or after the cut-off."""
    now = ts(now)
    return {
        1: F.add_months(F.trunc(now, "MM"), 1 - months).cast("timestamp"),
        30: F.date_trunc("day", now) + F.make_interval(days=F.lit(1 - days)),
        720: F.date_trunc("hour", now) + F.make_interval(hours=F.lit(1 - hours)),
    }


def retention_hold(h: DataFrame, now, months: int = 0, days: int = 0, hours: int = 0) -> DataFrame:
    """closed versions with an ``eligible`` flag (False = held for rolling snapshots)."""
    cut = hold_cutoff(now, months, days, hours)
    f = F.col("freq")
    eligible = (F.when(f == 1, F.col("deleted") < cut[1])
                .when(f == 30, F.col("deleted") < cut[30])
                .when(f == 720, F.col("deleted") < cut[720])
                .otherwise(F.lit(True)))
    return h.filter(f != 0).withColumn("eligible", eligible)


OBJECT_TIME_WIDTH = len("yyyy-MM-dd HH:mm:ss")  # the start time that object names begin with


def retention_fifo(h: DataFrame) -> DataFrame:
    """oldest end first, class ignored."""
    return h.filter(F.col("freq") != 0).orderBy("deleted", "dirname", "filename", "created", "row_id")


def retention_budget(scored: DataFrame, shortfall, size: str = "size", order: str = "score",
                     sidecars: DataFrame | None = None, name: str = "objname") -> DataFrame:
    """take candidates in order while the bytes freed before them are below the shortfall.

    ``order='score'``: largest ``age`` first (F1); ``order='fifo'``: oldest end first (F3).
    Directory rows weigh nothing but are removed too.  With ``sidecars`` (dirname, filename,
    object name, size) a victim also frees the objects that F8 removes with it.  The running
    sum is a global prefix sum done over range partitions (no single-task window).
    """
    s = scored.withColumn("_w", F.when(F.col("type") == "d", F.lit(0)).otherwise(F.col(size)).cast("long"))
    if sidecars is not None:
        extra = (sidecars.groupBy("dirname", "filename", F.substring(name, 1, OBJECT_TIME_WIDTH).alias("_p"))
                 .agg(F.sum(size).alias("_side")))
        s = s.withColumn("_p", fmt_time("created")).join(extra, ["dirname", "filename", "_p"], "left")
        s = s.withColumn("_w", F.col("_w") + F.when(F.col("type") == "d", F.lit(0)).otherwise(F.coalesce("_side", F.lit(0)))).drop("_p", "_side")
    if order == "score":
        s = s.withColumn("_order", -F.col("age"))
    elif order == "fifo":
        s = s.withColumn("_order", F.unix_micros("deleted"))
    else:
        raise ValueError(order)
    need = shortfall if isinstance(shortfall, Column) else F.lit(shortfall)
    s = _up_to_budget(s, need)
    c = global_exclusive_cumsum(s, ["_order", "dirname", "filename", "created", "row_id"], "_w", "freed_before")
    return c.filter(F.col("freed_before") < need).drop("_w", "_order")


def _up_to_budget(s: DataFrame, need: Column, buckets: int = 64) -> DataFrame:
    """Candidates without those that certainly lie behind the budget, so that only the rest is sorted.

    Quantiles of the order cut it into buckets; their byte sums (one small aggregate) tell from which bucket on
    the bytes before it already reach the shortfall. Ties of the order share a bucket."""
    bounds = s.agg(F.percentile_approx("_order", [i / buckets for i in range(1, buckets)], 1000)).head()[0]
    if not bounds:
        return s
    bounds = sorted(set(bounds))
    bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("_order")))
    per = s.groupBy(bucket.alias("b")).agg(F.sum("_w").alias("w"))
    first = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # at most ``buckets`` rows
    over = per.withColumn("_before", F.coalesce(F.sum("w").over(first), F.lit(0))).filter(F.col("_before") >= need)
    cut = over.agg(F.min("b")).head()[0]
    return s if cut is None else s.filter(bucket < cut)


def space_target(usage: DataFrame, value: int, unit: str = "%") -> DataFrame:
    """needed free MB from a percentage of the disk or an absolute number of GiB, and the shortfall.

    ``usage`` has one row with ``total_mb`` and ``free_mb``.
    """
    if unit == "%":
        needed = F.expr("total_mb div 100") * value
    elif unit == "G":
        needed = F.lit(value * 1024).cast("long")
    else:
        raise ValueError("unit must be '%' or 'G'")
    return (usage.withColumn("needed_mb", needed)
            .withColumn("shortfall_mb", F.greatest(F.col("needed_mb") - F.col("free_mb"), F.lit(0)).cast("long"))
            .withColumn("must_clean", F.col("free_mb") < F.col("needed_mb")))


def delete_where(h: DataFrame, cond) -> tuple[DataFrame, DataFrame]:
    """(kept, victims) for any predicate (a Column or SQL text); NULL counts as not matched."""
    c = F.expr(cond) if isinstance(cond, str) else cond
    hit = F.coalesce(c, F.lit(False))
    return h.filter(~hit), h.filter(hit)


def delete_prefix(h: DataFrame, prefix: str) -> DataFrame:
    """history without a subtree."""
    return h.filter(~F.col("dirname").startswith(prefix))


def purge_sidecars(victims: DataFrame, store: DataFrame, name: str = "objname") -> DataFrame:
    """F8: store objects of each victim: same path, object name beginning with its start time."""
    v = victims.select("dirname", "filename", fmt_time("created").alias("_p")).distinct()
    # the start time has a fixed width: an equal prefix is a join key, no victim meets all objects of its path
    return store.withColumn("_p", F.substring(name, 1, OBJECT_TIME_WIDTH)).join(v, ["dirname", "filename", "_p"]).drop("_p")


def expire_snapshots(snaps: DataFrame, grain: str, now, keep: int) -> DataFrame:
    """rolling snapshots kept for the last ``keep`` buckets of a grain (names compared as text)."""
    now = ts(now)
    if grain == "month":
        cut = F.date_format(F.add_months(F.trunc(now, "MM"), 1 - keep), "yyyy-MM")
    elif grain == "day":
        cut = F.date_format(now + F.make_interval(days=F.lit(1 - keep)), "yyyy-MM-dd")
    elif grain == "hour":
        cut = F.date_format(now + F.make_interval(hours=F.lit(1 - keep)), "yyyy-MM-dd HH")
    else:
        raise ValueError(grain)
    return snaps.filter(F.col("bucket") >= cut)


def calendar_throttle(events: DataFrame, grain: str, source: str = "source", t: str = "ts",
                      tie: str = "event_id") -> DataFrame:
    """a source runs at its first event in each hour/day/week/month bucket.

    ``min(struct(ts, id))`` per (source, bucket) is a partial aggregate, so a
    hot source is combined map-side instead of being sorted in one task.
    """
    from ..functions.times import throttle_bucket
    g = events.groupBy(F.col(source).alias("source"), throttle_bucket(grain, t).alias("bucket")).agg(
        F.min(F.struct(F.col(t).alias("run_ts"), F.col(tie).alias("event_id"))).alias("_r"))
    return g.select("source", "bucket", "_r.run_ts", "_r.event_id")


def usage_mb(sizes: DataFrame, size: str = "size", free_ratio: float = 0.05) -> DataFrame:
    """One-row disk usage from a size column (KiB units), with a free share (for F5)."""
    return sizes.agg(F.expr(f"sum(`{size}`) div 1024").alias("total_mb")).withColumn(
        "free_mb", (F.col("total_mb") * free_ratio).cast("long"))

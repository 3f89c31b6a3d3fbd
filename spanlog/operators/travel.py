"""Time travel: as-of snapshots, directory listings, versions, timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import freq_coarse, freq_label
from ..functions.paths import masks_regex, root_of, under
from ..functions.times import BUCKET_FORMAT, ceil_to, floor_to, step
from ..model import open_versions, ts
from ..plans.ordered import keyed_scan


def _t(x) -> Column:
    return ts(x)


def visible_at(t) -> Column:
    """Half-open validity: created <= t < deleted."""
    t = _t(t)
    return (F.col("created") <= t) & (F.col("deleted") > t)


def snapshot_as_of(h: DataFrame, t, prefix: str = "./") -> DataFrame:
    """Non-directory versions under ``prefix`` visible at ``t``."""
    return h.filter(under("dirname", prefix) & (F.col("type") != "d") & visible_at(t))


def list_dir(h: DataFrame, t, directory: str | None = None) -> DataFrame:
    """Direct children of one directory (or of every directory) at ``t``, without ``.``."""
    c = visible_at(t) & (F.col("filename") != ".")
    if directory is not None:
        c = c & (F.col("dirname") == directory)
    return (h.filter(c).select("dirname", "filename", "type", "created", "deleted")
            .orderBy("dirname", "type", "filename"))


def live_view(h: DataFrame) -> DataFrame:
    """D3: as-of "current" = open versions."""
    return open_versions(h)


def list_versions(h: DataFrame, directory: str | None = None, filename: str | None = None) -> DataFrame:
    """All versions of a path (or of every path) with class and label, by created."""
    c = F.lit(True)
    if directory is not None:
        c = c & (F.col("dirname") == directory)
    if filename is not None:
        c = c & (F.col("filename") == filename)
    return (h.filter(c).select("dirname", "filename", "created", "deleted", "freq",
                               freq_label("freq").alias("label"))
            .orderBy("dirname", "filename", "created"))


def get_version(h: DataFrame, contents: DataFrame, content_key: str = "doc_id") -> DataFrame:
    """The content row of each version (equi-join of history to a content table by version id)."""
    c = contents.withColumnRenamed(content_key, "inode")
    return h.join(c, "inode")


def bulk_as_of(probes: DataFrame, h: DataFrame, keys=("dirname", "filename"), t: str = "t",
               probe_id: str = "probe_id",
               payload=("row_id", "inode", "created", "deleted")) -> DataFrame:
    """For every probe (key, t) the version valid at t (NULLs when none).

    Versions and probes are merged in (key, time) order and the last version
    start at or before each probe is carried forward by a range-partitioned
    scan, so a key with a third of all rows is still split over many tasks and
    no probe is compared with all versions of its key.  Among versions with the
    same start the longest-lived one comes last (non-overlapping histories).
    """
    keys = list(keys)
    pay = list(payload)
    v = h.select(*keys, F.col("created").alias("_at"), F.lit(0).alias("_side"),
                 F.unix_micros("deleted").alias("_tie"), F.col("row_id").alias("_tie2"),
                 F.struct(*[F.col(c) for c in pay]).alias("_ver"))
    p = probes.select(*keys, F.col(t).alias("_at"), F.lit(1).alias("_side"),
                      F.col(probe_id).cast("long").alias("_tie"), F.col(probe_id).cast("long").alias("_tie2"),
                      F.lit(None).cast(v.schema["_ver"].dataType).alias("_ver"))
    s = keyed_scan(v.unionByName(p), keys, ["_at", "_side", "_tie", "_tie2"], ffill=["_ver"])
    s = s.filter(F.col("_side") == 1)
    found = F.col("ffill__ver")
    hit = found.isNotNull() & (found["deleted"] > F.col("_at"))
    return s.select(F.col("_tie").alias(probe_id), *keys, F.col("_at").alias(t),
                    *[F.when(hit, found[c]).alias(c) for c in pay])


def rolling_snapshots(h: DataFrame, grain: str, start, end) -> DataFrame:
    """Full snapshot at each grain boundary in [start, end]; bucket as directory name.

    Each version is exploded into exactly the boundaries it is visible at, so the
    work is proportional to the output; no join against a boundary list.
    """
    s, e = _t(start), _t(end)
    first = F.greatest(ceil_to(grain, "created"), ceil_to(grain, s))
    last = F.least(floor_to(grain, F.col("deleted") - F.expr("INTERVAL 1 MICROSECOND")), floor_to(grain, e))
    x = h.filter(F.col("type") != "d").withColumn("_b0", first).withColumn("_b1", last)
    x = x.filter(F.col("_b0") <= F.col("_b1"))
    x = x.withColumn("boundary", F.explode(F.sequence("_b0", "_b1", step(grain))))
    return x.select(F.date_format("boundary", BUCKET_FORMAT.get(grain, "yyyy-MM-dd HH:mm")).alias("bucket"),
                    "boundary", "dirname", "filename", "inode", "created", "deleted")


def boundary_runs(runs: DataFrame, grain: str, mode: str = "strict", t: str = "ts") -> DataFrame:
    """Which run makes the snapshot of each bucket.

    strict: only a run within the boundary minute; loose: the first run in the
    bucket, marked ``loose`` unless it is at the boundary.
    """
    b = floor_to(grain, t)
    r = runs.select(F.col(t).alias("run_ts"), b.alias("boundary"))
    at_boundary = F.date_trunc("minute", "run_ts") == F.col("boundary")
    if mode == "strict":
        r = r.filter(at_boundary)
    first = r.groupBy("boundary").agg(F.min("run_ts").alias("run_ts"))
    kind = F.when(F.date_trunc("minute", "run_ts") == F.col("boundary"), F.lit("strict")).otherwise(F.lit("loose"))
    return first.select(F.date_format("boundary", BUCKET_FORMAT.get(grain, "yyyy-MM-dd")).alias("bucket"),
                        "boundary", "run_ts", kind.alias("kind"))


def change_points(h: DataFrame, directory: str | None = None) -> DataFrame:
    """Distinct times something changed in a directory (all created, closed deleted)."""
    x = h if directory is None else h.filter(F.col("dirname") == directory)
    x = x.select("dirname", "created", "deleted", freq_coarse("freq").alias("cf"))
    a = x.select("dirname", F.col("created").alias("t"))
    b = x.filter(F.col("cf") != 0).select("dirname", F.col("deleted").alias("t"))
    return a.union(b).distinct()


def oldest_per_class(h: DataFrame, directory: str | None = None) -> DataFrame:
    """min(deleted) per shown class of closed versions, per directory."""
    x = h if directory is None else h.filter(F.col("dirname") == directory)
    x = x.select("dirname", "deleted", freq_coarse("freq").alias("freq")).filter(F.col("freq") != 0)
    return x.groupBy("dirname", "freq").agg(F.min("deleted").alias("oldest"))


# Grid step of each shown class on the timeline.
CLASS_STEP_SECONDS = {5: 604800, 30: 86400, 720: 3600, 8640: 300, 43800: 60}


def snap_start(t, freq, show_all: bool = False) -> Column:
    """Floor ``t`` to the class grain; one step later unless showing all."""
    t = _t(t) if not isinstance(t, Column) else t
    f = F.col(freq) if isinstance(freq, str) else freq
    floored = (F.when(f == 1, F.date_trunc("month", t))
               .when(f == 5, F.date_trunc("week", t))
               .when(f == 30, F.date_trunc("day", t))
               .when(f == 720, F.date_trunc("hour", t))
               .when(f == 8640, floor_to("5min", t))
               .otherwise(F.date_trunc("minute", t)))
    if show_all:
        return floored
    return (F.when(f == 1, F.add_months(floored, 1).cast("timestamp"))
            .otherwise(F.timestamp_seconds(F.unix_timestamp(floored) + _step_seconds(f))))


def _step_seconds(f: Column) -> Column:
    e = F.lit(60)
    for k, v in CLASS_STEP_SECONDS.items():
        e = F.when(f == k, F.lit(v)).otherwise(e)
    return e.cast("long")


def timeline_starts(h: DataFrame, show_all: bool = False) -> DataFrame:
    """Class segments of every directory: (dirname, freq, start)."""
    o = oldest_per_class(h)
    return o.select("dirname", "freq", snap_start(F.col("oldest"), "freq", show_all).alias("start"))


def _micros(c: Column) -> Column:
    return F.unix_micros(c)


def thin_timeline(changes: DataFrame, starts: DataFrame) -> DataFrame:
    """Grid times per class segment at which a not-yet-consumed change happened.

    Segment i of a directory covers ``[start_i, start_{i+1})`` (the last one ends
    at the last change) on the grid of its class.  A change is shown at the first
    grid time at or after it (at least ``start_i``).  Within a run of segments
    with non-decreasing starts, changes up to the last grid time of earlier
    segments are already consumed; a smaller start begins a new run.
    Segments are few per directory, so the windows below stay small.
    """
    last_change = changes.groupBy("dirname").agg(F.max("t").alias("_last"))
    w = Window.partitionBy("dirname").orderBy("freq")
    seg = (starts.join(last_change, "dirname")
           .withColumn("_upper", F.coalesce(F.lead("start").over(w), F.col("_last")))
           .withColumn("_restart", F.when(F.col("start") < F.lag("start").over(w), 1)
                       .when(F.lag("start").over(w).isNull(), 1).otherwise(0))
           .withColumn("_grp", F.sum("_restart").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    seg = seg.withColumn("_lastgrid", F.when(F.col("start") < F.col("_upper"), _last_grid_before()))
    wg = Window.partitionBy("dirname", "_grp").orderBy("freq").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_cons", F.max("_lastgrid").over(wg))
    j = changes.join(seg.select("dirname", "freq", "start", "_upper", "_cons"), "dirname")
    j = j.filter(F.col("_cons").isNull() | (F.col("t") > F.col("_cons")))
    j = j.withColumn("g", F.greatest(F.col("start"), _ceil_grid("t")))
    j = j.filter(F.col("g") < F.col("_upper"))
    return j.select("dirname", "freq", F.col("g").alias("t")).distinct()


def _months_between_starts(a: Column, b: Column) -> Column:
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def _add_months_ts(a: Column, k: Column) -> Column:
    return F.add_months(a, k).cast("timestamp")


def _last_grid_before() -> Column:
    """Largest grid time of the segment strictly before its upper bound."""
    s, u = F.col("start"), F.col("_upper")
    k = _months_between_starts(s, u)
    month = F.when(_add_months_ts(s, k) >= u, _add_months_ts(s, k - 1)).otherwise(_add_months_ts(s, k))
    step_us = _step_seconds(F.col("freq")) * F.lit(1000000)
    fixed = F.timestamp_micros(_micros(s) + F.floor((_micros(u) - _micros(s) - 1) / step_us).cast("long") * step_us)
    return F.when(F.col("freq") == 1, month).otherwise(fixed)


def _ceil_grid(t: str) -> Column:
    """First grid time of the segment at or after ``t``."""
    s, x = F.col("start"), F.col(t)
    k = _months_between_starts(s, x)
    month = F.when(_add_months_ts(s, k) < x, _add_months_ts(s, k + 1)).otherwise(_add_months_ts(s, k))
    step_us = _step_seconds(F.col("freq")) * F.lit(1000000)
    fixed = F.timestamp_micros(_micros(s) + F.ceil((_micros(x) - _micros(s)) / step_us).cast("long") * step_us)
    return F.when(F.col("freq") == 1, month).otherwise(fixed)


def timeline_ticks(starts: DataFrame, timeline: DataFrame) -> DataFrame:
    """Segment starts that are themselves on the timeline."""
    tl = timeline.select("dirname", F.col("t").alias("start")).distinct()
    return starts.join(tl, ["dirname", "start"], "left_semi")


def export_subtree(h: DataFrame, t, prefix: str = "./") -> DataFrame:
    """Files visible at ``t`` under a subtree with total size and count, per top directory."""
    x = snapshot_as_of(h, t, prefix)
    return x.groupBy(root_of("dirname").alias("root")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").cast("long").alias("total_size"))


def filter_masks(df: DataFrame, masks: list[str], col: str = "filename") -> DataFrame:
    """Rows whose whole name matches any glob mask, case-insensitive."""
    return df.filter(F.col(col).rlike(masks_regex(masks)))

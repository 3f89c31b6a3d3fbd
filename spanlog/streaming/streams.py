"""Structured Streaming forms: throttle, history upkeep per listing, intervals from change events.

Sources are file streams (``readStream``) read with ``trigger(availableNow=True)``. Results are Parquet tables written by
``foreachBatch`` under a path that holds the batch id, so a replayed batch overwrites its own output. Table and checkpoint
folders are arguments: a stream that is started again with the same two goes on where it stopped (left out, both are new folders
in the shared one). What a batch needs from the batches before it lies in the table, never in the driver: batch ``n`` reads
version ``n - 1``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.classes import freq_class
from ..functions.times import throttle_bucket
from ..model import KEY, ROW4, closed_versions, history_columns, open_versions
from ..operators.history import series_to_history
from ..session import reliable_checkpoint, scratch_path
from ..sources.commits import CommitTable, split_changes

EVENT_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def split_events(spark: SparkSession, sf_dir: str, parts: int = 4) -> str:
    """Copy the events table into files to stream from, for streams that take rows in any order."""
    from ..model import read_table
    out = scratch_path(spark, "events-stream")
    read_table(spark, sf_dir, "events").repartition(parts).write.parquet(out)
    return out


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def stream_in_time_order(rows: DataFrame, t: str, spans: int = 4, files: int | None = None, path: str | None = None) -> DataFrame:
    """A table as a stream whose triggers bring one span of time after the other, for streams that need that order.

    Spans are of equal length and begin at whole seconds, so rows of one second arrive together; rows without a time belong to the
    first. Every span is written by ``files`` parallel tasks (the cores, if left out) and taken by one trigger: file streams
    take files by age, so all spans get the same number of files, where rows are few by empty ones. An empty table is a stream
    without rows."""
    spark = rows.sparkSession
    files = files or spark.sparkContext.defaultParallelism
    path = path or scratch_path(spark, "in-time-order")
    second = F.unix_seconds(t)
    low, high = rows.agg(F.min(second), F.max(second)).head()
    cuts = [] if low is None else sorted({low + (high - low + 1) * i // spans for i in range(1, spans)} - {low})
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    span = F.coalesce(sum(((second >= cut).cast("int") for cut in cuts), F.lit(0)), F.lit(0))
    for i in range(len(cuts) + 1):
        rows.where(span == i).repartition(files).write.mode("append").parquet(path)
        while _data_files(spark, fs, path) < (i + 1) * files:
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _data_files(spark: SparkSession, fs, path: str) -> int:
    return sum(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)))


#: The state store that keyed operators need: state on disk, changes written per batch.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROGRESS_SECONDS = 0.5


def _run(query_writer, name: str, spark: SparkSession, checkpoint: str | None = None, state_partitions: int | None = None,
         store: str | None = None) -> int:
    """Run a stream to the end of its input; returns the rows that its watermark dropped as late.

    A stateful stream fixes its number of state partitions when it starts first. ``state_partitions`` sets it, for a cluster
    that may grow; left out, it is the session's number of shuffle partitions, or twice the cores if that is less. The
    session's settings are changed only while the query starts."""
    partitions = str(state_partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))
    wanted = {"spark.sql.shuffle.partitions": partitions} | ({"spark.sql.streaming.stateStore.providerClass": store} if store else {})
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        q = query_writer.option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-{name}")).trigger(availableNow=True).start()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # a query remembers its last hundred reports only, so they are gathered while it runs
    late: dict[int, int] = {}
    ended = False
    while not ended:
        ended = q.awaitTermination(PROGRESS_SECONDS)
        for p in q.recentProgress:
            late[p.batchId] = max(late.get(p.batchId, 0), sum(op.numRowsDroppedByWatermark for op in p.stateOperators))
    return sum(late.values())


def throttle_stream(stream: DataFrame, grain: str, spark: SparkSession, source: str = "source", t: str = "ts", tie: str = "event_id",
                    table: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """F10 on a stream.

    Each batch appends its own first event per (source, bucket), and reading takes the minimum over the batches. Minima can be
    merged in any order, so no state and no watermark are needed, no row is ever late, and the result equals the batch
    result whatever the arrival order."""
    out = table or scratch_path(spark, "throttle")

    def sink(df: DataFrame, batch_id: int) -> None:
        (df.groupBy(F.col(source).alias("source"), throttle_bucket(grain, t).alias("bucket"))
         .agg(F.min(F.struct(F.col(t).alias("run_ts"), F.col(tie).alias("event_id"))).alias("r"))
         .write.mode("overwrite").parquet(f"{out}/batch={batch_id}"))

    _run(stream.writeStream.foreachBatch(sink), "throttle", spark, checkpoint)
    r = spark.read.parquet(out)
    return (r.groupBy("source", "bucket").agg(F.min("r").alias("r"))
            .select("source", "bucket", "r.run_ts", "r.event_id"))


def apply_listings(h: DataFrame, listings: DataFrame, t: str = "t") -> DataFrame:
    """The history after several listings, in one pass (equals B6 for each in order of its time).

    A row without a path only says that a listing was taken at its time: that is how an empty listing is stated."""
    made = listed_versions(open_versions(h), listings, t)
    return history_columns(h) if made is None else history_columns(closed_versions(h)).unionByName(made)


def listed_versions(now: DataFrame, listings: DataFrame, t: str = "t") -> DataFrame | None:
    """What the open versions ``now`` have become after the listings, and the versions that began; None if there was no listing.

    The open versions stand for a listing before the first; those still there at the first time keep their start."""
    rows = listings.withColumnRenamed(t, "t").select("t", *ROW4)
    times = rows.select("t").distinct()
    first = times.agg(F.min("t")).head()[0]
    if first is None:
        return None
    before = F.lit(first) - F.expr("INTERVAL 1 SECOND")
    again = rows.filter(F.col("dirname").isNotNull()).unionByName(now.select(before.alias("t"), *ROW4))
    made = series_to_history(again, times.unionByName(times.limit(1).select(before.alias("t"))))
    start = now.select(*ROW4, F.col("row_id").alias("_id"), F.col("created").alias("_since"))
    made = made.join(start.withColumn("_old", F.lit(True)), ROW4, "left")
    old = F.col("_old").isNotNull() & (F.col("created") == before)
    made = (made.withColumn("row_id", F.when(old, F.col("_id")).otherwise(F.col("row_id")))
            .withColumn("created", F.when(old, F.col("_since")).otherwise(F.col("created")))
            .withColumn("freq", freq_class("created", "deleted")))
    return history_columns(made)


def history_stream(listings: DataFrame, spark: SparkSession, start: DataFrame, t: str = "t", table: str | None = None,
                   checkpoint: str | None = None) -> DataFrame:
    """Arriving listings (rows with their snapshot time, see ``apply_listings``) are committed to the history.

    The history is a ``CommitTable``: a batch reads the open versions and writes the changes, closed ones are neither read nor
    written again. ``start`` is version 0, written when the stream starts first. A batch replayed after a failure is found
    in the log and commits nothing. Batches must hold whole listings, in time order from batch to batch."""
    log = CommitTable(spark, table or scratch_path(spark, "history"))
    log.create(start)

    def sink(df: DataFrame, batch_id: int) -> None:
        if log.version().batches.get("listings", -1) >= batch_id:
            return
        now = log.open()
        made = listed_versions(now, df, t)
        if made is not None:
            made = reliable_checkpoint(made)  # both halves come from one computation
            log.commit(*split_changes(now, made), source="listings", batch=batch_id)

    _run(listings.writeStream.foreachBatch(sink), "history", spark, checkpoint)
    return log.read()


STATE_BUCKETS = 64
INTERVAL_OUT = "dirname string, filename string, inode long, created_us long, deleted_us long, late boolean"


class OpenVersions(StatefulProcessor):
    """The open version of every path in the state store, paths dealt into buckets: a batch reads and writes the entries of its own
    paths and no other, and a bucket's rows are cut into intervals together."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "dirname string, filename string", "inode long, created_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        x = pd.concat(list(rows), ignore_index=True)
        path = x.groupby(KEY, dropna=False, sort=False).ngroup().to_numpy()
        first = np.unique(path, return_index=True)[1]
        names = [tuple(None if pd.isna(v) else v for v in r) for r in x.loc[first, KEY].itertuples(index=False)]
        held = [self.open.getValue(n) for n in names]
        known = np.array([h is not None for h in held], bool)
        open_inode, open_since = np.array([h if h is not None else (0, 0) for h in held], np.int64).T
        since, inode = x["created_us"].to_numpy(np.int64), x["inode"].to_numpy(np.int64)
        late = known[path] & ((since < open_since[path]) | ((since == open_since[path]) & (inode < open_inode[path])))
        # the open versions stand before the batch's rows of their paths
        of = np.concatenate([np.nonzero(known)[0], path[~late]])
        at, who = np.concatenate([open_since[known], since[~late]]), np.concatenate([open_inode[known], inode[~late]])
        order = np.lexsort((who, at, of))
        of, at, who = of[order], at[order], who[order]
        last = np.append(of[1:] != of[:-1], True) if len(of) else np.empty(0, bool)
        for p, i, t in zip(of[last].tolist(), who[last].tolist(), at[last].tolist(), strict=True):
            if held[p] is None or (i, t) != tuple(held[p]):
                self.open.updateValue(names[p], (i, t))
        ended = np.nonzero(~last)[0]
        which = np.concatenate([of[ended], path[late]])
        text = [pd.Series([names[p][i] for p in which.tolist()], dtype=object) for i in (0, 1)]
        yield pd.DataFrame({"dirname": text[0], "filename": text[1],
                            "inode": np.concatenate([who[ended], inode[late]]), "created_us": np.concatenate([at[ended], since[late]]),
                            "deleted_us": np.concatenate([at[ended + 1], since[late]]), "late": np.arange(len(which)) >= len(ended)})

    def close(self) -> None:
        pass


def interval_stream(changes: DataFrame, spark: SparkSession, table: str | None = None, checkpoint: str | None = None,
                    buckets: int = STATE_BUCKETS) -> DataFrame:
    """Keyed change events (dirname, filename, inode, created) -> closed intervals as they end.

    The open version of each path is an entry of the state store (RocksDB), so a batch costs what it brings, however many paths are
    open. ``buckets`` bounds the tasks that share the paths and stays as it was when the stream started first. Within a batch rows come in any order. An event older than its path's open version is too late to cut anything: it
    goes to ``late_events`` instead. Rows without inode or time are left out. One bucket's rows of one batch meet in one
    task: the trigger's size bounds them."""
    base = table or scratch_path(spark, "intervals")
    rows = changes.where("inode IS NOT NULL AND created IS NOT NULL").select(
        F.pmod(F.xxhash64(*KEY), F.lit(buckets)).alias("bucket"), *KEY, "inode", F.unix_micros("created").alias("created_us"))
    s = rows.groupBy("bucket").transformWithStateInPandas(statefulProcessor=OpenVersions(), outputStructType=INTERVAL_OUT, outputMode="Append",
                                                      timeMode="None")

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").partitionBy("late").parquet(f"{base}/batch={batch_id}")

    _run(s.writeStream.outputMode("append").foreachBatch(sink), "intervals", spark, checkpoint, store=ROCKSDB)
    done = _intervals(spark, base).where(~F.col("late"))
    return done.select(F.col("inode").alias("row_id"), "inode", F.lit("f").alias("type"), *KEY,
                       F.timestamp_micros("created_us").alias("created"), F.timestamp_micros("deleted_us").alias("deleted"))


def _intervals(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(f"{INTERVAL_OUT}, batch long").option("basePath", base).parquet(f"{base}/batch=*")


def late_events(spark: SparkSession, table: str) -> DataFrame:
    """The events that ``interval_stream`` set aside, with the batch that brought them."""
    return _intervals(spark, table).where("late").select(*KEY, "inode", F.timestamp_micros("created_us").alias("created"), "batch")


@dataclass
class StreamResult:
    """What a stream with a watermark emitted, and how many of its input rows came too late to count."""
    rows: DataFrame
    late_rows: int


DEBOUNCE_OUT = "key long, batch_start timestamp, fire_at timestamp, n_events long"
DEBOUNCE_STATE = "pending binary"  # rows of (key is null, key, batch start, fire time, size), 64-bit integers
DEBOUNCE_BUCKETS = 256


def _debounce_state(gap_us: int, thr_us: int):
    def fn(bucket, pdfs: Iterator[pd.DataFrame], state):
        held = np.frombuffer(state.get[0], np.int64).reshape(-1, 5).tolist() if state.exists else []
        pending = {(none, key): (t0, fire, n) for none, key, t0, fire, n in held}
        out = []
        if not state.hasTimedOut:
            x = pd.concat(list(pdfs), ignore_index=True)
            order = np.lexsort((x["t"], x["key"], x["none"]))
            last = None
            for none, key, t in zip(*(x[c].to_numpy(np.int64)[order].tolist() for c in ("none", "key", "t")), strict=True):
                if (none, key) != last:
                    if last is not None:
                        pending[last] = (t0, fire, n)
                    last = (none, key)
                    t0, fire, n = pending.get(last, (t, t + gap_us, 0))
                if n and t >= fire:
                    out.append((none, key, t0, fire, n))
                    t0, fire, n = t, t + gap_us, 1
                else:
                    n += 1
                    if t - t0 < thr_us:
                        fire = t + gap_us
            if last is not None:
                pending[last] = (t0, fire, n)
        # a batch fires once the watermark (an event at or after the fire time) has passed it
        now = state.getCurrentWatermarkMs()
        rows = np.array([(*k, *v) for k, v in pending.items()], np.int64).reshape(-1, 5)
        due = -(-rows[:, 3] // 1000)
        out = np.concatenate([np.array(out, np.int64).reshape(-1, 5), rows[due < now]])
        if (due < now).all():
            state.remove()
        else:
            state.update((rows[due >= now].tobytes(),))
            state.setTimeoutTimestamp(int(due[due >= now].min()))
        if len(out):
            yield pd.DataFrame({"key": pd.arrays.IntegerArray(out[:, 1].copy(), out[:, 0] == 1),
                                "batch_start": pd.to_datetime(out[:, 2], unit="us"),
                                "fire_at": pd.to_datetime(out[:, 3], unit="us"),
                                "n_events": out[:, 4]})
    return fn


def debounce_stream(stream: DataFrame, spark: SparkSession, key: str, ts: str, gap_s: int, max_s: int, delay: str,
                    table: str | None = None, checkpoint: str | None = None, buckets: int = DEBOUNCE_BUCKETS) -> StreamResult:
    """L1/L2 on a stream: each key's pending batch (start, fire time, size) as state, with event-time timeouts.

    A batch is emitted when a later event of its key arrives at or after its fire
    time, or when the watermark passes the fire time; a batch still pending when
    the input ends is not emitted (as the reference loses it).  Within a batch rows may
    come in any order; from batch to batch they must be in time order per key.  Rows that
    lie more than ``delay`` before the newest one seen are dropped and counted; rows without a time are left out, a null key
    is a key. Keys are dealt into ``buckets``: Python is called and state is read once per bucket and trigger, not once per key. One
    bucket's rows of one trigger meet in one task; the number stays as it was when the stream started first.
    """
    out = table or scratch_path(spark, "debounce")
    k = F.col(key).cast("long")
    x = stream.select(F.pmod(F.xxhash64(k), F.lit(buckets)).alias("bucket"), k.isNull().cast("long").alias("none"),
                      F.coalesce(k, F.lit(0)).alias("key"), F.col(ts).alias("ts"), F.unix_micros(F.col(ts)).alias("t")).where("ts IS NOT NULL")
    s = (x.withWatermark("ts", delay).groupBy("bucket")
         .applyInPandasWithState(_debounce_state(gap_s * 1_000_000, (max_s - gap_s) * 1_000_000),
                                 DEBOUNCE_OUT, DEBOUNCE_STATE, "append", GroupStateTimeout.EventTimeTimeout))

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    late = _run(s.writeStream.outputMode("append").foreachBatch(sink), "debounce", spark, checkpoint)
    return StreamResult(spark.read.parquet(out).drop("batch"), late)


def session_stream(stream: DataFrame, spark: SparkSession, key: str, ts: str, gap_s: int, delay: str,
                   table: str | None = None, checkpoint: str | None = None) -> StreamResult:
    """L3 on a stream: session windows per key in append mode; a session is emitted once the watermark, ``delay`` behind
    the newest row, has passed its end, so the sessions still open at the end of the input are not emitted (they stay
    in the state for a stream that goes on).  Rows behind the watermark are dropped and counted."""
    out = table or scratch_path(spark, "sessions")
    w = F.session_window(F.col(ts), f"{gap_s} seconds")
    agg = (stream.withWatermark(ts, delay)
           .groupBy(F.col(key).cast("long").alias("key"), w.alias("s"))
           .agg(F.count(F.lit(1)).alias("n_events"))
           .select("key", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events"))

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    late = _run(agg.writeStream.outputMode("append").foreachBatch(sink), "sessions", spark, checkpoint)
    return StreamResult(spark.read.parquet(out).drop("batch"), late)

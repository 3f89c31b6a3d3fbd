"""Stream forms against their batch forms: any arrival order, late rows, going on after a stop (smallest data set)."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from spanlog.model import empty_history, read_table
from spanlog.operators.history import apply_snapshot
from spanlog.operators.retention import calendar_throttle
from spanlog.streaming import streams as St
from spanlog.streaming.debounce import debounce_loop


def _events(spark):
    return read_table(spark, SF_SMALL, "events")


def _backwards(spark, path):
    """All events in three files, the latest first."""
    e = _events(spark)
    lo, hi = e.agg(F.min("event_id"), F.max("event_id")).head()
    step = (hi - lo) // 3 + 1
    for i in (2, 1, 0):
        e.filter((F.col("event_id") >= lo + i * step) & (F.col("event_id") < lo + (i + 1) * step)).coalesce(1).write.mode("append").parquet(path)


def test_throttle_stream_equals_batch_in_any_order_and_restores_settings(spark, tmp_path):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    _backwards(spark, f"{tmp_path}/in")
    got = St.throttle_stream(St.event_stream(spark, f"{tmp_path}/in"), "daily", spark, source="user_id")
    assert spark.conf.get(key) == before
    want = calendar_throttle(_events(spark), "daily", source="user_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_counted(spark, tmp_path):
    _backwards(spark, f"{tmp_path}/in")
    total = _events(spark).count()
    strict = St.session_stream(St.event_stream(spark, f"{tmp_path}/in"), spark, "user_id", "ts", 3600, delay="0 seconds")
    counted = strict.rows.agg(F.sum("n_events")).head()[0]
    patient = St.session_stream(St.event_stream(spark, f"{tmp_path}/in"), spark, "user_id", "ts", 3600, delay="60 days")
    assert strict.late_rows > 0 and patient.late_rows == 0
    # what is neither emitted nor late lies in sessions that the end of the input leaves open
    end = _events(spark).agg(F.max("ts")).head()[0]
    still = _events(spark).filter(F.col("ts") > F.lit(end) - F.expr("INTERVAL 2 DAYS")).count()
    assert 0 <= total - counted - strict.late_rows <= still


def test_throttle_and_intervals_go_on_after_a_stop(spark, tmp_path):
    e = _events(spark).withColumn("dirname", F.concat(F.lit("./u"), F.col("user_id").cast("string"), F.lit("/"))) \
        .select("dirname", F.col("event_type").alias("filename"), F.col("event_id").alias("inode"), F.col("ts").alias("created"))
    cut = e.agg(F.expr("percentile_approx(inode, 0.6)")).head()[0]
    paths = {"table": f"{tmp_path}/t", "checkpoint": f"{tmp_path}/c"}
    for part in (F.col("inode") <= cut, F.col("inode") > cut):
        e.filter(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        got = St.interval_stream(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in"), spark, **paths)
    e.write.parquet(f"{tmp_path}/all")
    want = St.interval_stream(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/all"), spark)
    assert got.count() > 100
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_history_goes_on_after_a_stop_and_takes_empty_listings(spark, tmp_path):
    schema = "t timestamp, inode long, type string, dirname string, filename string"
    days = {"2024-01-01": [(1, "x"), (2, "y")], "2024-01-02": [(1, "x"), (3, "y")], "2024-01-03": [], "2024-01-04": [(3, "y")], "2024-01-05": [(3, "y"), (5, "z")]}
    paths = {"table": f"{tmp_path}/t", "checkpoint": f"{tmp_path}/c"}
    want = empty_history(spark)
    for t, rows in days.items():
        listing = [(inode, "f", "./a/", name) for inode, name in rows]
        marked = [(t, None, None, None, None), *[(t, *r) for r in listing]]
        df = spark.createDataFrame(marked, schema.replace("t timestamp", "t string")).withColumn("t", F.to_timestamp("t"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        inv = spark.createDataFrame(listing, "inode long, type string, dirname string, filename string")
        want = spark.createDataFrame(apply_snapshot(want, inv, f"{t} 00:00:00").history.collect(), want.schema)
        if t in ("2024-01-02", "2024-01-05"):  # the stream runs twice, from the same folders
            src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
            got = St.history_stream(src, spark, empty_history(spark), **paths)
    columns = ["inode", "type", "dirname", "filename", "created", "deleted", "freq"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_intervals_keep_state_per_path_and_set_late_events_aside(spark, tmp_path):
    """Three batches; the second repeats a time and comes unsorted, the third brings an event older than its path's open version."""
    schema = "dirname string, filename string, inode long, created timestamp"
    batches = [[("./a/", "x", 1, "2024-01-01"), ("./a/", "y", 2, "2024-01-02"), ("./a/", "x", None, "2024-01-02"), ("./a/", "x", 9, None)],
               [("./a/", "x", 5, "2024-01-07"), ("./a/", "x", 4, "2024-01-05"), ("./a/", "x", 3, "2024-01-05"), (None, "n", 6, "2024-01-06")],
               [("./a/", "x", 7, "2024-01-06"), ("./a/", "y", 8, "2024-01-09"), (None, "n", 10, "2024-01-10")]]
    paths = {"table": f"{tmp_path}/t", "checkpoint": f"{tmp_path}/c"}
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    for rows in batches:  # the stream is stopped after every batch and goes on from its folders
        df = spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("created", F.to_timestamp("created"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        got = St.interval_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), spark, **paths)
    found = sorted([(r["inode"], str(r["created"])[:10], str(r["deleted"])[:10]) for r in got.collect()])
    assert found == [(1, "2024-01-01", "2024-01-05"), (2, "2024-01-02", "2024-01-09"), (3, "2024-01-05", "2024-01-05"), (4, "2024-01-05", "2024-01-07"),
                     (6, "2024-01-06", "2024-01-10")]
    assert [(r["inode"], r["batch"]) for r in St.late_events(spark, paths["table"]).collect()] == [(7, 2)]
    assert spark.conf.get(provider) == before


def test_spans_of_time_arrive_in_order_one_trigger_each(spark, tmp_path):
    """Rows without a time come first, rows of one second together; few rows fill up with empty files; no rows, no crash."""
    schema = "k long, ts timestamp, event_id long"
    rows = [(1, None, 0), (None, "2024-01-01 00:00:00", 1), *[(i % 3, f"2024-01-{1 + i // 4:02d} 00:00:0{i % 2}.{i % 5}", i) for i in range(2, 90)]]
    df = spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("ts", F.to_timestamp("ts"))
    src = St.stream_in_time_order(df, "ts", spans=5, files=3, path=f"{tmp_path}/in")
    seen = []
    q = (src.writeStream.foreachBatch(lambda b, i: seen.append((i, b.agg(F.min("ts"), F.max("ts"), F.count("*"), F.sum(F.col("ts").isNull().cast("int"))).head())))
         .option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [i for i, _ in seen] == [0, 1, 2, 3, 4] and sum(r[2] for _, r in seen) == len(rows)
    assert [r[3] for _, r in seen] == [1, 0, 0, 0, 0]
    assert all(a[1].replace(microsecond=0) < b[0].replace(microsecond=0) for (_, a), (_, b) in zip(seen, seen[1:]))
    none = df.where("false")
    assert St.session_stream(St.stream_in_time_order(none, "ts", files=2), spark, "k", "ts", 60, delay="0 seconds").rows.count() == 0
    one = df.where("event_id = 5")
    assert St.debounce_stream(St.stream_in_time_order(one, "ts", files=2), spark, "k", "ts", 60, 120, delay="0 seconds").late_rows == 0


def test_debounce_stream_takes_null_keys_and_times(spark, tmp_path):
    rows = [(None, "2024-01-01 00:00:00", 1), (None, "2024-01-01 00:00:30", 2), (None, None, 3), (4, "2024-01-01 00:10:00", 4), (None, "2024-01-01 00:20:00", 5)]
    df = spark.createDataFrame(rows, "k long, ts string, event_id long").withColumn("ts", F.to_timestamp("ts"))
    got = St.debounce_stream(St.stream_in_time_order(df, "ts", files=1), spark, "k", "ts", 60, 120, delay="0 seconds").rows.collect()
    assert sorted((r["key"] or 0, str(r["batch_start"])[11:], str(r["fire_at"])[11:], r["n_events"]) for r in got) == [
        (0, "00:00:00", "00:01:30", 2), (4, "00:10:00", "00:11:00", 1)]


def test_debounce_stream_keeps_one_state_entry_per_bucket(spark, tmp_path):
    """Many keys share a bucket: same batches as the plain loop, each fired by its own time; state and calls go by bucket, not by key."""
    rng = random.Random(5)
    rows = sorted({(rng.choice([None, *range(-20, 20)]), rng.randrange(3000)) for _ in range(900)}, key=str)
    df = spark.createDataFrame([(k, 1_700_000_000 + t) for k, t in rows], "k long, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    for gap, most in ((40, 40), (40, 130)):
        out = St.debounce_stream(St.stream_in_time_order(df, "ts", spans=3, files=2), spark, "k", "ts", gap, most, delay="0 seconds",
                                 checkpoint=f"{tmp_path}/{most}", buckets=3)
        got = out.rows.select("key", F.unix_micros("batch_start").alias("a"), F.unix_micros("fire_at").alias("b"), "n_events").collect()
        loop = debounce_loop(sorted((99 if k is None else k, (1_700_000_000 + t) * 1_000_000) for k, t in rows), gap * 1_000_000, most * 1_000_000)
        end = (1_700_000_000 + max(t for _, t in rows)) * 1_000_000
        want = [(None if k == 99 else k, a, b, n) for k, a, b, n in loop if b < end]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and out.late_rows == 0
        held = spark.read.format("statestore").load(f"{tmp_path}/{most}").count()
        assert held <= 3 < len(loop) - len(want)

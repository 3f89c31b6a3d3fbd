"""Chains followed by doubling, and the debounce rule built on them, against plain loops."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from spanlog.plans import pointers
from spanlog.streaming import debounce as L


def test_reached_places_equal_a_walk(spark, monkeypatch):
    r = random.Random(5)
    links = {(k, i): r.randrange(i + 1, i + 6) for k in (1, 2) for i in range(200) if r.random() < 0.95}
    heads = {(1, 0), (1, 77), (2, 3), (3, 9)}
    want = set()
    for k, at in heads:
        while (k, at) not in want:
            want.add((k, at))
            at = links.get((k, at), at)
    rounds = []
    monkeypatch.setattr(pointers, "reliable_checkpoint", lambda df, own=pointers.reliable_checkpoint: rounds.append(1) or own(df))
    got = pointers.reached(spark.createDataFrame(sorted(heads), "k int, at int"), spark.createDataFrame([(*a, b) for a, b in links.items()], "k int, at int, to int"), ["k"], "at", "to")
    assert {tuple(x) for x in got.collect()} == want
    assert len(rounds) <= 1 + 2 * 8  # 200 places: eight rounds at most
    empty = spark.createDataFrame([], "k int, at int, to int")
    assert pointers.reached(empty.select("k", "at"), empty, ["k"], "at", "to").count() == 0


def _events(spark, rows):
    return spark.createDataFrame(rows, "user_id long, us long").select("user_id", F.timestamp_micros("us").alias("ts"))


def _batches(df):
    zero = datetime(1970, 1, 1)
    return sorted((r.key, *((t - zero) // timedelta(microseconds=1) for t in (r.batch_start, r.fire_at)), r.n_events) for r in df.collect())


def test_batches_equal_the_loop(spark):
    r = random.Random(8)
    rows = []
    for k in range(6):
        t = 1_700_000_000
        for _ in range(120):
            t += r.choice([0, 1, 5, 9, 10, 11, 25])
            rows.append((k, t * 1_000_000 + (r.randrange(3) if k > 3 else 0)))
    rows += [(99, 1_700_000_000_000_000 + i * 7_000_000) for i in range(3000)]  # a session that never ends
    for gap, most in ((10, 40), (10, 10), (10, 23)):
        got = _batches(L.debounce_by_jumps(_events(spark, rows), "user_id", "ts", gap, most))
        assert got == sorted(L.debounce_loop(sorted(rows), gap * 1_000_000, most * 1_000_000))


def test_no_events_and_events_without_key_or_time(spark):
    assert L.debounce_by_jumps(_events(spark, []), "user_id", "ts", 10, 40).count() == 0
    assert _batches(L.debounce_by_jumps(_events(spark, [(None, 5), (1, None), (1, 7)]), "user_id", "ts", 10, 40)) == [(1, 7, 10_000_007, 1)]

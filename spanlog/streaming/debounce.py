"""Debouncing of event streams (batch form).

A batch starts at its first event t0 and fires ``gap`` after it; an event
before the fire time joins the batch and postpones the fire to ``t + gap`` if
it came less than ``max - gap`` after t0 (so a batch fires at most ``max``
after it started); the first event at or after the fire time starts the next
batch.  ``max = gap`` never postpones (the reference's script as written).

The rule is a sequential fold, but a batch never spans a silence longer than
``gap``: events are first cut into sessions at such silences (range-
partitioned scans, so a hot key is split), sessions are hash-partitioned,
and each partition is folded in one streaming pass over its sorted rows
(O(1) state; no group is collected into memory).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import keyed_scan
from ..plans.pointers import reached
from ..session import reliable_checkpoint

BATCH_SCHEMA = "key long, batch_start timestamp, fire_at timestamp, n_events long"
RUN_SCHEMA = "key long, batch_start timestamp, fire_at timestamp, run_start timestamp, n_events long"


def sessions(df: DataFrame, key: str, ts: str, gap_s: int, tie: str, at_gap: bool = False) -> DataFrame:
    """Session id (start time in µs) per event: a new session after a silence longer than
    ``gap`` (or at least ``gap`` with ``at_gap``, the session-window rule)."""
    x = df.select(F.col(key).cast("long").alias("key"), F.unix_micros(F.col(ts)).alias("t"),
                  F.col(tie).cast("long").alias("tie"))
    x = keyed_scan(x, ["key"], ["t", "tie"], lag=["t"], keep_ranges=True)
    silence = F.col("t") - F.col("lag_t")
    brk = silence >= gap_s * 1_000_000 if at_gap else silence > gap_s * 1_000_000
    x = x.withColumn("_start", F.when(F.col("lag_t").isNull() | brk, F.col("t")))
    x = keyed_scan(x.drop("lag_t"), ["key"], ["t", "tie"], ffill=["_start"])
    return x.select("key", "t", "tie", F.col("ffill__start").alias("session"))


def pending_end(ts: np.ndarray, at: int, quiet: np.ndarray, t0: int, fire: int, gap_us: int, thr_us: int) -> tuple[int, int]:
    """The end of a pending batch among the events ``ts[at:]`` of its session, and its fire time.

    The events before ``t0 + thr`` postpone, up to the first silence of ``gap`` (``quiet`` holds the events after one);
    then those before the fire time just join.  Two binary searches per batch, whatever its size."""
    if at == len(ts) or ts[at] >= fire:
        return at, fire
    late = max(at, int(np.searchsorted(ts, t0 + thr_us)))
    if late > at:
        k = int(np.searchsorted(quiet, at, side="right"))
        stop = min(late, int(quiet[k]) if k < len(quiet) else len(ts))
        fire = int(ts[stop - 1]) + gap_us
        if stop < late:
            return stop, fire
    return max(late, int(np.searchsorted(ts, fire))), fire


def _fold(gap_us: int, thr_us: int):
    def run(it):
        cur = None  # (key, session, t0, fire, n): the batch pending at the end of a chunk
        for pdf in it:
            out = []
            ks, ss, ts = pdf["key"].to_numpy(), pdf["session"].to_numpy(), pdf["t"].to_numpy()
            new = np.nonzero(np.concatenate([[True], (ks[1:] != ks[:-1]) | (ss[1:] != ss[:-1])]))[0] if len(ts) else []
            for b, e in zip(new, [*new[1:], len(ts)]):
                key, session, own = int(ks[b]), int(ss[b]), ts[b:e]
                quiet = np.nonzero(np.diff(own) >= gap_us)[0] + 1
                if cur is not None and (cur[0], cur[1]) != (key, session):
                    out.append((cur[0], cur[2], cur[3], cur[4]))
                    cur = None
                at = 0
                while at < len(own):
                    if cur is None:
                        t0, n, fire, start = int(own[at]), 1, int(own[at]) + gap_us, at + 1
                    else:
                        t0, fire, n, start = cur[2], cur[3], cur[4], at
                    at, fire = pending_end(own, start, quiet, t0, fire, gap_us, thr_us)
                    cur = (key, session, t0, fire, n + at - start)
                    if at < len(own):
                        out.append((key, t0, fire, cur[4]))
                        cur = None
            if out:
                yield _batches(out)
        if cur is not None:
            yield _batches([(cur[0], cur[2], cur[3], cur[4])])
    return run


def _batches(rows) -> pd.DataFrame:
    a = np.array(rows, dtype="int64").reshape(-1, 4)
    return pd.DataFrame({"key": a[:, 0], "batch_start": pd.to_datetime(a[:, 1], unit="us"),
                         "fire_at": pd.to_datetime(a[:, 2], unit="us"), "n_events": a[:, 3]})


def debounce(df: DataFrame, key: str, ts: str, gap_s: int, max_s: int, tie: str = "event_id",
             partitions: int | None = None) -> DataFrame:
    """L1 (and L2 with ``max_s == gap_s``): one row per batch with its start, fire time and size.

    A batch still pending at the end of the input is emitted too (the reference
    loses it when its input ends).
    """
    s = sessions(df, key, ts, gap_s, tie)
    # AQE sizes the partitions unless a count is given (fewer Python workers on small data)
    s = s.repartition(partitions, "key", "session") if partitions else s.repartition("key", "session")
    s = s.sortWithinPartitions("key", "session", "t", "tie")
    out = s.mapInPandas(_fold(gap_s * 1_000_000, (max_s - gap_s) * 1_000_000), BATCH_SCHEMA)
    return out


def debounce_by_jumps(df: DataFrame, key: str, ts: str, gap_s: int, max_s: int) -> DataFrame:
    """L1 (and L2) without a fold: equal to ``debounce``, for keys with sessions that never end.

    A batch that starts at a time is the same whatever came before, so its fire time, and with it the start of the batch after it,
    is found for every time at once by ordered scans; a silence of ``gap`` starts a batch in any case. The starts that come about
    are those reached from these (``pointers.reached``), so one endless session is worked on by all tasks. Events without a
    key or time belong to no batch."""
    gap, thr = gap_s * 1_000_000, (max_s - gap_s) * 1_000_000
    times = (df.select(F.col(key).cast("long").alias("key"), F.unix_micros(F.col(ts)).alias("t"))
             .where("key IS NOT NULL AND t IS NOT NULL").groupBy("key", "t").agg(F.count("*").alias("n")))
    x = keyed_scan(times, ["key"], ["t"], lag=["t"], keep_ranges=True)
    quiet = F.col("lag_t").isNull() | (F.col("t") - F.col("lag_t") >= gap)
    x = keyed_scan(x.withColumn("_run", F.when(quiet, F.col("t"))).drop("lag_t"), ["key"], ["t"], ffill=["_run"])
    x = reliable_checkpoint(x.select("key", "t", "n", F.col("ffill__run").alias("run")))  # a run has no silence of gap within
    none = F.lit(None).cast("long")
    # the last time that postpones: the last one of the run before t + thr, or t itself
    asks = x.select("key", "run", (F.col("t") + thr).alias("at"), F.lit(0).alias("side"), F.col("t").alias("start"), none.alias("seen"))
    seen = x.select("key", "run", F.col("t").alias("at"), F.lit(1).alias("side"), F.col("t").alias("start"), F.col("t").alias("seen"))
    last = keyed_scan(asks.unionByName(seen), ["key", "run"], ["at", "side", "start"], ffill=["seen"]).where("side = 0")
    fires = last.select("key", "run", "start", (F.greatest("start", "ffill_seen") + gap).alias("fire"))
    fires = reliable_checkpoint(fires)
    # the start after it: the first time of the run at or after the fire time (beyond the run a new run starts one)
    asks = fires.select("key", "run", (-F.col("fire")).alias("at"), F.lit(1).alias("side"), "start", none.alias("seen"))
    seen = x.select("key", "run", (-F.col("t")).alias("at"), F.lit(0).alias("side"), F.col("t").alias("start"), F.col("t").alias("seen"))
    links = keyed_scan(asks.unionByName(seen), ["key", "run"], ["at", "side", "start"], ffill=["seen"]).where("side = 1 AND ffill_seen IS NOT NULL")
    heads = x.where("t = run").select("key", F.col("t").alias("start"))
    starts = reached(heads, links.select("key", "start", F.col("ffill_seen").alias("to")), ["key"], "start", "to")
    marked = x.join(starts.select("key", F.col("start").alias("t"), F.col("start").alias("batch")), ["key", "t"], "left")
    sizes = keyed_scan(marked, ["key"], ["t"], ffill=["batch"]).groupBy("key", F.col("ffill_batch").alias("start")).agg(F.sum("n").alias("n_events"))
    return sizes.join(fires.select("key", "start", "fire"), ["key", "start"]).select(
        "key", F.timestamp_micros("start").alias("batch_start"), F.timestamp_micros("fire").alias("fire_at"), "n_events")


def session_windows(df: DataFrame, key: str, ts: str, gap_s: int, tie: str = "event_id") -> DataFrame:
    """L3: the limit case max = infinity: sessions (start, last event + gap, count).

    Same result as Spark's ``session_window`` (a new session when the silence is
    at least ``gap``), but session ids come from range-partitioned scans and the
    sessions are a grouped aggregate, so a hot key is not sorted in one task.
    """
    s = sessions(df, key, ts, gap_s, tie, at_gap=True)
    g = s.groupBy("key", "session").agg(F.max("t").alias("_last"), F.count(F.lit(1)).alias("n_events"))
    return g.select("key", F.timestamp_micros("session").alias("session_start"),
                    F.timestamp_micros(F.col("_last") + gap_s * 1_000_000).alias("session_end"), "n_events")


def _fold_busy(gap_us: int, thr_us: int, run_us: int):
    def run(it):
        unit = None             # (key, session) being folded
        t0 = fire = None
        n = 0
        busy = None
        for pdf in it:
            out = []
            ks, ss, ts = pdf["key"].to_numpy(), pdf["session"].to_numpy(), pdf["t"].to_numpy()
            for i in range(len(ts)):
                u, t = (int(ks[i]), int(ss[i])), int(ts[i])
                if unit is not None and u != unit:
                    if t0 is not None:
                        out.append(_flush_busy(unit[0], t0, fire, n, busy, gap_us))
                    t0, fire, n, busy = None, None, 0, None
                unit = u
                key = u[0]
                # alarms falling due before this event
                while t0 is not None and fire <= t:
                    if busy is not None and fire < busy:
                        fire += gap_us          # still running: check again later
                    else:
                        out.append((key, t0, fire, fire, n))
                        busy = fire + run_us
                        t0, n = None, 0
                if t0 is None:
                    t0, fire, n = t, t + gap_us, 1
                else:
                    if t - t0 < thr_us:
                        fire = t + gap_us
                    n += 1
            if out:
                yield _runs(out)
        if unit is not None and t0 is not None:
            yield _runs([_flush_busy(unit[0], t0, fire, n, busy, gap_us)])
    return run


def _flush_busy(key, t0, fire, n, busy, gap_us):
    while busy is not None and fire < busy:
        fire += gap_us
    return (key, t0, fire, fire, n)


def _runs(rows) -> pd.DataFrame:
    a = np.array(rows, dtype="int64").reshape(-1, 5)
    return pd.DataFrame({"key": a[:, 0], "batch_start": pd.to_datetime(a[:, 1], unit="us"),
                         "fire_at": pd.to_datetime(a[:, 2], unit="us"), "run_start": pd.to_datetime(a[:, 3], unit="us"),
                         "n_events": a[:, 4]})


def busy_coalesce(df: DataFrame, key: str, ts: str, gap_s: int, max_s: int, run_s: int,
                  tie: str = "event_id", partitions: int | None = None) -> DataFrame:
    """L4: batches falling due while the previous run (``run_s`` long) is active wait,
    re-checking every ``gap``; events arriving meanwhile join the waiting batch.

    A pending batch fires at most ``run + gap`` after its last event and its run
    ends ``run`` later, so after a silence longer than ``2 * run + gap`` nothing
    of the earlier state matters: keys are cut into sessions at such silences
    (range-partitioned scans) and each session is folded on its own, in one
    streaming pass per partition with constant state.
    """
    s = sessions(df, key, ts, 2 * run_s + gap_s, tie)
    s = s.repartition(partitions, "key", "session") if partitions else s.repartition("key", "session")
    s = s.sortWithinPartitions("key", "session", "t", "tie")
    return s.mapInPandas(_fold_busy(gap_s * 1_000_000, (max_s - gap_s) * 1_000_000, run_s * 1_000_000), RUN_SCHEMA)


def debounce_loop(events: list[tuple[int, int]], gap_us: int, max_us: int) -> list[tuple[int, int, int, int]]:
    """Reference loop over (key, t) events sorted by (key, t): the test oracle of ``debounce``."""
    out, cur = [], None
    for k, t in events:
        if cur is not None and (cur[0] != k or t >= cur[2]):
            out.append(tuple(cur))
            cur = None
        if cur is None:
            cur = [k, t, t + gap_us, 1]
        else:
            if t - cur[1] < max_us - gap_us:
                cur[2] = t + gap_us
            cur[3] += 1
    if cur is not None:
        out.append(tuple(cur))
    return out

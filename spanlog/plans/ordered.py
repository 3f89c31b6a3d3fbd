"""Sequential scans (lag, last-non-null, running sum and minimum) that do not put a hot key in one task.

A ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task.
When one key may hold a third of the rows, that task is the whole job.  The
scans here range-partition on ``keys + order`` instead, so a hot key is cut
into many partitions; each partition is scanned with a window over its own
partition id, and a small per-partition summary (one row per partition,
broadcast: its size is bounded by the partition count) carries the state
across partition borders.

The range-partitioned data is checkpointed to the shared folder first: the
partition ids are read twice and range bounds come from sampling.  One exchange
by partition id follows, each range to its own reducer; windows and summaries share it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_PID = "_pid"


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _ranged(df: DataFrame, keys: list[str], order: list[str], partitions: int | None):
    # Without an explicit count, AQE sizes the range partitions from the data (it only merges
    # neighbouring ranges, so every partition stays one contiguous stretch of the order).
    if partitions:
        r = df.repartitionByRange(partitions, *_cols(keys + order))
    else:
        r = df.repartitionByRange(*_cols(keys + order))
    r = reliable_checkpoint(r)
    # every range goes to a reducer of its own: the windows and summaries below need no further
    # exchange, and ranges stay as even as they were cut (hashing their ids would pile some up)
    return r.withColumn(_PID, F.spark_partition_id()).repartitionById(max(1, r.rdd.getNumPartitions()), F.col(_PID))


def _key_struct(keys: list[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], *,
               lag: list[str] = (), ffill: list[str] = (), cumsum: list[str] = (), cummin: list[str] = (),
               partitions: int | None = None, keep_ranges: bool = False) -> DataFrame:
    """Add ``lag_<c>``, ``ffill_<c>`` (last non-null at or before the row), ``cumsum_<c>`` and
    ``cummin_<c>`` (inclusive running sum and minimum) within each key in ``order``.

    ``keys + order`` must be a total order of the rows.  With ``keep_ranges`` the result
    keeps its ranges (column ``_pid``), and a second scan of it by the same keys and order
    needs no new ranges, checkpoint or exchange.  Column names starting with
    ``_k``, ``_pid``, ``_first``, ``_lag_``, ``_ff_``, ``_cf_``, ``_krun_``, ``_kmin_``, ``_cs_``, ``_cm_`` and ``_cprev``
    are used internally.
    """
    clash = {"_k", "_first", "_fk", "_cprev"} & set(df.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    r = df if _PID in df.columns else _ranged(df, list(keys), list(order), partitions)
    w = Window.partitionBy(_PID).orderBy(*_cols(list(keys) + list(order)))
    wrun = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    k = _key_struct(list(keys))
    r = r.withColumn("_k", k)
    r = r.withColumn("_first", F.row_number().over(w) == 1)
    for c in lag:
        prev = F.lag(F.struct(F.col("_k").alias("k"), F.col(c).alias("v"))).over(w)
        r = r.withColumn(f"_lag_{c}", prev)
    for c in ffill:
        last = F.last(F.when(F.col(c).isNotNull(), F.struct(F.col("_k").alias("k"), F.col(c).alias("v"))),
                      ignorenulls=True).over(wrun)
        r = r.withColumn(f"_ff_{c}", last)
    if cumsum or cummin:
        wk = Window.partitionBy(_PID, "_k").orderBy(*_cols(list(order))) \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for c in cumsum:
            r = r.withColumn(f"_krun_{c}", F.sum(F.col(c)).over(wk))
        for c in cummin:
            r = r.withColumn(f"_kmin_{c}", F.min(F.col(c)).over(wk))

    # one row per partition: first key, last key, and the state at its end
    tail_fields = [F.col("_k").alias("lk")]
    tail_fields += [F.col(c).alias(f"lv_{c}") for c in lag]
    tail_fields += [F.col(f"_ff_{c}").alias(f"lf_{c}") for c in ffill]
    tail_fields += [F.col(f"_krun_{c}").alias(f"ls_{c}") for c in cumsum]
    tail_fields += [F.col(f"_kmin_{c}").alias(f"lm_{c}") for c in cummin]
    ordkey = F.struct(*_cols(list(keys) + list(order)))
    tails = r.groupBy(_PID).agg(
        F.min_by(F.col("_k"), ordkey).alias("fk"),
        F.max_by(F.struct(*tail_fields), ordkey).alias("t"))
    carry = _carry(tails, lag, ffill, cumsum, cummin)
    r = r.join(F.broadcast(carry), _PID, "left")

    out = r
    for c in lag:
        out = out.withColumn(f"lag_{c}", F.when(
            F.col("_first"),
            F.when(F.col("_cprev.k") == F.col("_k"), F.col(f"_cprev.v_{c}")))
            .otherwise(F.when(F.col(f"_lag_{c}.k") == F.col("_k"), F.col(f"_lag_{c}.v"))))
    for c in ffill:
        own = F.when(F.col(f"_ff_{c}.k") == F.col("_k"), F.col(f"_ff_{c}.v"))
        out = out.withColumn(f"ffill_{c}", F.coalesce(own, F.when(F.col("_k") == F.col("_fk"), F.col(f"_cf_{c}"))))
    for c in cumsum:
        out = out.withColumn(f"cumsum_{c}", F.col(f"_krun_{c}") + F.when(
            F.col("_k") == F.col("_fk"), F.coalesce(F.col(f"_cs_{c}"), F.lit(0))).otherwise(F.lit(0)))
    for c in cummin:
        out = out.withColumn(f"cummin_{c}", F.least(F.col(f"_kmin_{c}"), F.when(F.col("_k") == F.col("_fk"), F.col(f"_cm_{c}"))))
    internal = {_PID, "_k", "_first", "_fk", "_cprev"}
    internal |= {f"_lag_{c}" for c in lag} | {f"_ff_{c}" for c in ffill} | {f"_cf_{c}" for c in ffill}
    internal |= {f"_krun_{c}" for c in cumsum} | {f"_cs_{c}" for c in cumsum}
    internal |= {f"_kmin_{c}" for c in cummin} | {f"_cm_{c}" for c in cummin}
    if keep_ranges:
        internal.discard(_PID)
    return out.drop(*[x for x in out.columns if x in internal])


def _carry(tails: DataFrame, lag, ffill, cumsum, cummin=()) -> DataFrame:
    """State entering each partition, from the one-row-per-partition summary.

    Partitions whose last key is k form a contiguous block (keys are sorted),
    and only the block ending right before partition p can continue into p's
    first key.  A running aggregate per block (window by last key, ordered by
    partition id) and one lag over partition ids give the carry: linear in the
    number of partitions, no join of the summary with itself.
    """
    t = tails.select(_PID, F.col("fk").alias("_fk"), F.col("t.lk").alias("_lk"),
                     *[F.col(f"t.lv_{c}").alias(f"_lv_{c}") for c in lag],
                     *[F.col(f"t.lf_{c}").alias(f"_lf_{c}") for c in ffill],
                     *[F.col(f"t.ls_{c}").alias(f"_ls_{c}") for c in cumsum],
                     *[F.col(f"t.lm_{c}").alias(f"_lm_{c}") for c in cummin])
    block = Window.partitionBy("_lk").orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for c in ffill:
        own = F.when(F.col(f"_lf_{c}").isNotNull() & (F.col(f"_lf_{c}.k") == F.col("_lk")), F.col(f"_lf_{c}.v"))
        t = t.withColumn(f"_bf_{c}", F.last(own, ignorenulls=True).over(block))
    for c in cumsum:
        t = t.withColumn(f"_bs_{c}", F.sum(F.col(f"_ls_{c}")).over(block))
    for c in cummin:
        t = t.withColumn(f"_bm_{c}", F.min(F.col(f"_lm_{c}")).over(block))
    prev = F.lag(F.struct(F.col("_lk").alias("k"),
                          *[F.col(f"_lv_{c}").alias(f"v_{c}") for c in lag],
                          *[F.col(f"_bf_{c}").alias(f"f_{c}") for c in ffill],
                          *[F.col(f"_bs_{c}").alias(f"s_{c}") for c in cumsum],
                          *[F.col(f"_bm_{c}").alias(f"m_{c}") for c in cummin])).over(Window.orderBy(_PID))
    t = t.withColumn("_cprev", prev)
    same = F.col("_cprev.k") == F.col("_fk")
    return t.select(_PID, "_fk", "_cprev",
                    *[F.when(same, F.col(f"_cprev.f_{c}")).alias(f"_cf_{c}") for c in ffill],
                    *[F.when(same, F.col(f"_cprev.s_{c}")).alias(f"_cs_{c}") for c in cumsum],
                    *[F.when(same, F.col(f"_cprev.m_{c}")).alias(f"_cm_{c}") for c in cummin])


def global_exclusive_cumsum(df: DataFrame, order: list[str], col: str, out: str,
                            partitions: int | None = None) -> DataFrame:
    """Sum of ``col`` over all rows strictly before each row in ``order`` (a total order)."""
    r = keyed_scan(df.withColumn("_one", F.lit(0)), [], list(order), cumsum=[col], partitions=partitions)
    return r.withColumn(out, F.col(f"cumsum_{col}") - F.col(col)).drop(f"cumsum_{col}", "_one")

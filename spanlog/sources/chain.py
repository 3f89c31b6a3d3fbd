"""Rolling snapshots as a chain: what each boundary adds and removes, and now and then a whole snapshot.

``rolling_snapshots`` gives a row per version and boundary; a version that nobody touches for years is repeated at each. Here a
boundary stores the versions that became visible since the one before and those that ceased to be, and a *base* holds a whole
snapshot. A base is due when the changes since the last one exceed ``BASE_SHARE`` of the snapshot, so all bases together hold at
most 1 / ``BASE_SHARE`` rows per change, and a bucket is read from one base and at most ``BASE_SHARE`` times its rows of changes:
both the stored rows and the reading follow the changes, not the number of boundaries.

A chain is extended with the history as it is later: boundaries done are neither read nor written again. Each extension is a folder of
Parquet files, sorted by boundary, and a manifest (``ManifestLog``), whose publishing makes it visible; a lost job leaves files
that nothing names. The driver handles one row per boundary with changes: its counts, from which the bases are chosen.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import BUCKET_FORMAT, ceil_to, floor_to, step
from ..model import ts
from .commits import ManifestLog

BASE_SHARE = 0.5
#: A version in a snapshot. Its end is not part of it: a snapshot does not know it.
ENTRY = ["dirname", "filename", "inode", "created"]
STORED = "boundary timestamp, dirname string, filename string, inode long, created timestamp, copies long"


def _same(keys: list[str], other: str) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(other + c)) for c in keys])


class SnapshotChain(ManifestLog):
    """Snapshots of a history at every boundary of a grain (hour, day, week, month, ...)."""

    def __init__(self, spark: SparkSession, path: str, grain: str = "day"):
        super().__init__(spark, path)
        self.grain = grain

    def _parts(self) -> list[dict]:
        return [self._read(n) for n in self._numbers()]

    # writing

    def _boundaries(self, start: Column, end: Column) -> list[str]:
        """The boundaries in [start, end]."""
        one = self.spark.range(1).select(ceil_to(self.grain, start).alias("a"), floor_to(self.grain, end).alias("b")).where("a <= b")
        rows = one.select(F.explode(F.sequence("a", "b", step(self.grain))).alias("t")).select(F.date_format("t", "yyyy-MM-dd HH:mm:ss")).collect()
        return [r[0] for r in rows]

    def extend(self, h: DataFrame, end: str, start: str | None = None) -> int:
        """Adds the boundaries after the last one done (the first time: from ``start``) up to ``end``; returns how many.

        ``h`` is the history as known now: versions that ended since then ended after the last boundary done. Repeated rows
        count as so many copies; a version without a start is there from the beginning, one without an end to the last boundary, as
        in D7; directories are left out."""
        parts = self._parts()
        done = parts[-1]["end"] if parts else None
        if done is None and start is None:
            raise ValueError("a chain begins at a start")
        times = [t for t in self._boundaries(ts(done or start), ts(end)) if done is None or t > done]
        if not times:
            return 0
        first = parts[0]["start"] if parts else times[0]
        low = F.greatest(ceil_to(self.grain, "created"), ts(first))
        high = F.least(floor_to(self.grain, F.col("deleted") - F.expr("INTERVAL 1 MICROSECOND")), ts(times[-1]))
        seen = h.where(F.col("type") != "d").select(*ENTRY, low.alias("_low"), high.alias("_high")).where("_low <= _high")
        after = F.col("_high") + step(self.grain)
        folder = f"data/{len(parts):06d}-{uuid.uuid4().hex}"
        new = F.col("boundary") >= ts(times[0])
        adds = seen.select(F.col("_low").alias("boundary"), *ENTRY).where(new)
        removes = seen.select(after.alias("boundary"), *ENTRY).where(new & (F.col("boundary") <= ts(times[-1])))
        self._write(adds, f"{folder}/adds")
        self._write(removes, f"{folder}/removes")
        counts: dict[str, list[int]] = {}
        for i, kind in enumerate(("adds", "removes")):
            day = F.date_format("boundary", "yyyy-MM-dd HH:mm:ss").alias("t")
            for r in self._stored([f"{folder}/{kind}"]).groupBy(day).agg(F.sum("copies").alias("n")).collect():  # a row per boundary
                counts.setdefault(r["t"], [0, 0])[i] = r["n"]
        live, since = (parts[-1]["live"], parts[-1]["since"]) if parts else (0, 0)
        bases: list[str] = []
        for t in sorted(counts):
            plus, minus = counts[t]
            live, since = live + plus - minus, since + plus + minus
            if since > BASE_SHARE * max(live, 1):
                bases.append(t)
                since = 0
        if not parts and (not bases or bases[0] != times[0]):
            bases.insert(0, times[0])  # a chain begins with a base, be it empty
        self._write(self._at_bases(seen, times, bases), f"{folder}/bases")
        self._publish({"version": len(parts), "folder": folder, "grain": self.grain, "start": times[0], "end": times[-1], "bases": bases,
                       "live": live, "since": since})
        return len(times)

    def _at_bases(self, seen: DataFrame, times: list[str], bases: list[str]) -> DataFrame:
        """The snapshots at ``bases``: every version once per base it is visible at. A version's boundaries find their bases in a
        table with one row per boundary."""
        table = self.spark.createDataFrame([(t, bisect_left(bases, t), bisect_right(bases, t) - 1) for t in times], "t string, from_base int, to_base int")
        table = table.withColumn("t", F.to_timestamp("t"))
        names = self.spark.createDataFrame(list(enumerate(bases)), "base int, t string").select("base", F.to_timestamp("t").alias("boundary"))
        x = seen.where(F.col("_high") >= ts(times[0])).withColumn("_low", F.greatest("_low", ts(times[0])))
        x = x.join(table.select(F.col("t").alias("_low"), "from_base"), "_low").join(table.select(F.col("t").alias("_high"), "to_base"), "_high")
        x = x.where("from_base <= to_base").withColumn("base", F.explode(F.sequence("from_base", "to_base")))
        return x.join(names, "base").select("boundary", *ENTRY)

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Rows as (boundary, entry, copies), ranges of boundary and path per file: one boundary may hold most rows."""
        (rows.groupBy("boundary", *ENTRY).agg(F.count("*").alias("copies")).repartitionByRange("boundary", "dirname", "filename", "created")
         .sortWithinPartitions("boundary", "dirname", "filename", "created").write.parquet(f"{self.path}/{folder}"))

    # reading

    def _stored(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(*[f"{self.path}/{f}" for f in folders])

    def rows(self, kind: str) -> DataFrame:
        """Everything stored of a kind (``adds``, ``removes``, ``bases``) with its boundary."""
        return self._stored([f"{p['folder']}/{kind}" for p in self._parts()])

    def bases(self) -> list[str]:
        return [b for p in self._parts() for b in p["bases"]]

    def snapshot(self, boundary: str) -> DataFrame:
        """The snapshot at a boundary, from its base and the changes after it. The base's rows stay where they are if Spark finds the
        removals small enough to send."""
        parts = self._parts()
        if not parts or not parts[0]["start"] <= boundary <= parts[-1]["end"]:
            raise ValueError(f"no boundary {boundary} in the chain")
        base = max(b for b in self.bases() if b <= boundary)
        own = [p for p in parts if p["end"] >= base and p["start"] <= boundary]
        later = (F.col("boundary") > ts(base)) & (F.col("boundary") <= ts(boundary))
        there = self._stored([f"{p['folder']}/bases" for p in own if base in p["bases"]]).where(F.col("boundary") == ts(base))
        there = there.unionByName(self._stored([f"{p['folder']}/adds" for p in own]).where(later)).drop("boundary")
        gone = self._stored([f"{p['folder']}/removes" for p in own]).where(later).groupBy(*ENTRY).agg(F.sum("copies").alias("_gone"))
        # copies of an entry become visible together (at its start), so an entry comes from the base or from the additions
        left = there.join(gone.select(*[F.col(c).alias(f"_{c}") for c in ENTRY], "_gone"), _same(ENTRY, "_"), "left")
        left = left.withColumn("copies", F.col("copies") - F.coalesce("_gone", F.lit(0))).where("copies > 0")
        return left.select(*ENTRY, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy")).drop("_copy")

    def all_snapshots(self) -> DataFrame:
        """Every boundary's snapshot (the rows of D7 without the end): stored rows are counted forward to the next base."""
        parts = self._parts()
        times = [t for p in parts for t in self._boundaries(ts(p["start"]), ts(p["end"]))]
        bases = self.bases()
        reach = [(t, (bases + [None])[bisect_right(bases, t)]) for t in times]  # the base that ends what is stored at t
        until = self.spark.createDataFrame([(t, times[bisect_left(times, n) - 1] if n else times[-1]) for t, n in reach], "boundary string, last string")
        until = until.select(F.to_timestamp("boundary").alias("boundary"), F.to_timestamp("last").alias("last"))
        based = self.spark.createDataFrame([(t,) for t in bases], "t string").select(F.to_timestamp("t").alias("boundary"))
        # a base replaces the changes of its own boundary
        changes = self.rows("adds").unionByName(self.rows("removes").withColumn("copies", -F.col("copies"))).join(based, "boundary", "left_anti")
        x = changes.unionByName(self.rows("bases")).join(until, "boundary")
        x = x.withColumn("boundary", F.explode(F.sequence("boundary", "last", step(self.grain))))
        x = x.groupBy("boundary", *ENTRY).agg(F.sum("copies").alias("copies")).where("copies > 0")
        return x.select(F.date_format("boundary", BUCKET_FORMAT.get(self.grain, "yyyy-MM-dd HH:mm")).alias("bucket"), "boundary", *ENTRY,
                        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy")).drop("_copy")

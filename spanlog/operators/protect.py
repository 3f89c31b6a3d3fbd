"""Content protection audit: which versions to protect, digests, verification.

The reference protects version files with parity archives made by an external
tool; here the protection record is a digest manifest computed by Spark over
whole contents (see README: re-aimed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import ts

VKEY = ["dirname", "filename", "created"]
# Fixed value: below this size a version is copied whole, above it gets parity.
COPY_LIMIT = 300000


def _month_start(now, back: int = 0):
    return F.add_months(F.trunc(ts(now), "MM"), -back).cast("timestamp")


def protect_eligible(h: DataFrame, now, newer_than: int | None = None, older_than: int | None = None) -> DataFrame:
    """K1: file versions open or of month class, started before this month (optional window of months)."""
    c = (F.col("type") == "f") & (F.col("freq") < 2)
    c = c & (F.col("created") < _month_start(now, older_than or 0))
    if newer_than is not None:
        c = c & (F.col("created") >= _month_start(now, newer_than))
    return h.filter(c)


def protect_order(df: DataFrame, mode: str = "dir", seed: int = 0) -> DataFrame:
    """K2: by directory, newest first, or a repeatable random order."""
    if mode == "dir":
        return df.orderBy("dirname", "filename", "created")
    if mode == "newest":
        return df.orderBy(F.desc("created"), "dirname", "filename")
    if mode == "random":
        return df.orderBy(F.xxhash64("dirname", "filename", "created", F.lit(seed)))
    raise ValueError(mode)


def protect_tier(df: DataFrame, limit: int = COPY_LIMIT, size: str = "size") -> DataFrame:
    """K3."""
    return df.withColumn("tier", F.when(F.col(size) < limit, F.lit("copy")).otherwise(F.lit("parity")))


def protect_pending(eligible: DataFrame, manifest: DataFrame) -> DataFrame:
    """K4: eligible versions without a manifest entry, keyed by (path, created) only."""
    return eligible.join(manifest.select(*VKEY), VKEY, "left_anti")


def build_manifest(versions: DataFrame, text: str = "text", limit: int = COPY_LIMIT) -> DataFrame:
    """K5: digest and length of the whole content of each version, with its tier."""
    m = versions.select(*VKEY, F.sha2(F.col(text), 256).alias("digest"),
                        F.octet_length(F.col(text)).cast("long").alias("size"))
    return protect_tier(m, limit)


def verify_manifest(contents: DataFrame, manifest: DataFrame, text: str = "text") -> DataFrame:
    """K6: status per version: ok / differs / not_protected / target_missing."""
    cur = contents.select(*VKEY, F.sha2(F.col(text), 256).alias("now_digest"))
    j = cur.join(manifest.select(*VKEY, "digest"), VKEY, "full")
    status = (F.when(F.col("digest").isNull(), F.lit("not_protected"))
              .when(F.col("now_digest").isNull(), F.lit("target_missing"))
              .when(F.col("digest") == F.col("now_digest"), F.lit("ok"))
              .otherwise(F.lit("differs")))
    return j.withColumn("status", status)


def resolve_renamed(requests: DataFrame, store: DataFrame) -> DataFrame:
    """K7: a request names a version as still open; find its store object by (path, created).

    Exactly one object: resolved to its end; none: missing; several: ambiguous.
    """
    g = store.groupBy(*VKEY).agg(F.count(F.lit(1)).alias("n"), F.max("deleted").alias("deleted"))
    j = requests.select(*VKEY).join(g, VKEY, "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    status = F.when(n == 1, F.lit("resolved")).when(n == 0, F.lit("missing")).otherwise(F.lit("ambiguous"))
    return j.select(*VKEY, F.when(n == 1, F.col("deleted")).alias("deleted"), status.alias("status"))


def verify_summary(v: DataFrame) -> DataFrame:
    """K8."""
    return v.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def sidecar_files(versions: DataFrame, limit: int = COPY_LIMIT) -> DataFrame:
    """Store files with their protection sidecars: ``.bak`` copies below the limit,
    ``.par2`` index plus a ``.vol`` volume above it (sizes as a tenth and a fifth)."""
    v = versions.select(F.concat("dirname", "filename").alias("objname"), "size")
    bak = v.filter(F.col("size") < limit).select(F.concat("objname", F.lit(".bak")).alias("objname"), "size")
    big = v.filter(F.col("size") >= limit)
    par = big.select(F.concat("objname", F.lit(".par2")).alias("objname"), (F.col("size") / 10).cast("long").alias("size"))
    vol = big.select(F.concat("objname", F.lit(".vol000+01.par2")).alias("objname"),
                     (F.col("size") / 5).cast("long").alias("size"))
    return v.unionByName(bak).unionByName(par).unionByName(vol)


def block_digests(contents: DataFrame, key: str = "doc_id", text: str = "text", block: int = 4096) -> DataFrame:
    """K5 option: SHA-256 of every ``block``-character block of each whole content."""
    # the text is cut once and the pieces are exploded, not a copy of the text per block
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    pieces = F.when(F.size(pieces) > 0, pieces).otherwise(F.array(F.col(text)))  # null or empty: one block
    x = contents.select(F.col(key), F.posexplode(pieces).alias("block", "_part"))
    return x.select(F.col(key), F.col("block").cast("long").alias("block"), F.sha2("_part", 256).alias("digest"),
                    F.length("_part").cast("long").alias("chars"))

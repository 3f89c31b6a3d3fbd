"""Data model of a version-interval history.

One row per version of an entity key ``(dirname, filename)``; ``inode`` is the
version id, ``[created, deleted)`` the half-open validity interval and ``freq``
the importance class of the interval (see ``functions.classes``).
Open versions carry the far-future sentinel as ``deleted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The open marker and its text forms.
OPEN_TEXT = "2199-12-31 00:00:00"   # sentinel valid-to of open versions
NOW_WORD = "now"                    # how open versions are written in names
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss" # text form of times in rendered names
KEY = ["dirname", "filename"]
# a version is identified by all of these: hashed row ids of inserted versions may meet
VERSION = ["row_id", "inode", "dirname", "filename", "created", "deleted"]
ROW4 = ["inode", "type", "dirname", "filename"]

HISTORY_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("inode", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("dirname", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("created", T.TimestampType()),
    T.StructField("deleted", T.TimestampType()),
    T.StructField("freq", T.LongType()),
])


def open_ts() -> Column:
    """The open sentinel as a TIMESTAMP literal (session zone is UTC)."""
    return F.to_timestamp(F.lit(OPEN_TEXT))


def ts(value) -> Column:
    """A timestamp literal from text or a Column."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.to_timestamp(F.lit(str(value)))


def is_open(deleted: Column | str = "deleted") -> Column:
    c = F.col(deleted) if isinstance(deleted, str) else deleted
    return c == open_ts()


def open_versions(h: DataFrame) -> DataFrame:
    """The open versions; of a stored history table (it carries ``is_open``) only the open partition is read."""
    if "is_open" in h.columns:
        h = h.filter(F.col("is_open") == 1).drop("is_open")
    return h.filter(is_open("deleted"))


def closed_versions(h: DataFrame) -> DataFrame:
    """All other versions; of a stored history table only the closed partition is read."""
    if "is_open" in h.columns:
        h = h.filter(F.col("is_open") == 0).drop("is_open")
    return h.filter(~F.coalesce(is_open("deleted"), F.lit(False)))


def row_id_of(*cols) -> Column:
    """Deterministic row id of a newly inserted version."""
    return F.xxhash64(*cols)


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HISTORY_SCHEMA)


def with_freq(h: DataFrame, max_freq: int = 8640) -> DataFrame:
    """(Re)compute the stored class column of a history table."""
    from .functions.classes import freq_class
    return h.withColumn("freq", freq_class("created", "deleted", max_freq))


def history_columns(h: DataFrame) -> DataFrame:
    return h.select([f.name for f in HISTORY_SCHEMA.fields])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given parquet tables; zone-less timestamps become TIMESTAMP."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    casts = [F.col(f.name).cast("timestamp").alias(f.name)
             if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
             for f in df.schema.fields]
    return df.select(casts)


def to_output(df: DataFrame) -> DataFrame:
    """Present results with zone-less timestamps (wall clock, as stored)."""
    cols = [F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return df.select(cols)


def fmt_time(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, TIME_FORMAT)


def show_deleted(deleted: Column | str = "deleted") -> Column:
    """Text of valid-to: the word ``now`` for open versions."""
    c = F.col(deleted) if isinstance(deleted, str) else deleted
    return F.when(is_open(c), F.lit(NOW_WORD)).otherwise(fmt_time(c))

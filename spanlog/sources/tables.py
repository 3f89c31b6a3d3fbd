"""History tables in Parquet: laid out so that the common filters prune files.

* ``is_open`` is a partition column: the diff of a new listing, the live view and
  the checks on open versions read only the open partition.
* Rows are range-partitioned and sorted by (dirname, filename, created) inside
  each file, so Parquet min/max statistics prune directory-prefix and key
  lookups (``PushedFilters`` on ``dirname``) and joins on the key read sorted runs.
* A new version of the table is always written to a new location and read back
  (no read-and-overwrite of the same path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..model import HISTORY_SCHEMA, history_columns, is_open


def write_history(h: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists",
                  sorted_layout: bool = True) -> None:
    """Write a history table; ``sorted_layout=False`` keeps only the open/closed partitioning
    (for short-lived intermediate versions: no range sampling, no sort)."""
    # 1/0 rather than a boolean: partition values are inferred back as integers
    out = history_columns(h).withColumn("is_open", is_open("deleted").cast("int"))
    if not sorted_layout:
        out.write.mode(mode).partitionBy("is_open").parquet(path)
        return
    ranged = (out.repartitionByRange(files, "dirname", "filename", "created") if files
              else out.repartitionByRange("dirname", "filename", "created"))  # AQE sizes the files
    (ranged
     .sortWithinPartitions("dirname", "filename", "created")
     .write.mode(mode).partitionBy("is_open").parquet(path))


def read_history(spark: SparkSession, path: str, open_only: bool = False) -> DataFrame:
    """The table with its partition column ``is_open``, by which ``open_versions`` prunes; ``history_columns`` drops it."""
    schema = T.StructType(HISTORY_SCHEMA.fields + [T.StructField("is_open", T.IntegerType())])
    h = spark.read.schema(schema).parquet(path)
    if open_only:
        h = h.filter(F.col("is_open") == 1)
    return h


def write_snapshots(snaps: DataFrame, path: str, grain: str, mode: str = "errorifexists") -> None:
    """Rolling snapshots (D7 output) as a table partitioned by grain and bucket; a large snapshot is cut by its paths."""
    (snaps.withColumn("grain", F.lit(grain)).repartitionByRange("bucket", "dirname", "filename")
     .write.mode(mode).partitionBy("grain", "bucket").parquet(path))

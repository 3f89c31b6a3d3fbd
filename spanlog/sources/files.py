"""File-system sources and text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import split_path
from ..plans.ordered import global_exclusive_cumsum


def scan_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """A2: list a file tree as an inventory with size and modification time.

    Only ``path``, ``length`` and ``modificationTime`` are selected, so the
    binary-file source never reads file contents.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(path))
    df = df.select("path", "length", "modificationTime")
    rel = F.regexp_replace("path", r"^[a-z]+:", "")
    d, f = split_path(rel)
    return df.select(F.lit("f").alias("type"), d.alias("dirname"), f.alias("filename"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines numbered from 0 in the order of their files' paths and, within a file, of the lines.

    Order-sensitive parsers need it. A line's place is (file, start of its piece of the file, row number within the scan), for a
    scan may pack files in any order but reads a piece from front to back; a global running count turns it into a number.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_piece"),
        F.monotonically_increasing_id().alias("_row"), F.lit(1).cast("long").alias("_line"))
    return global_exclusive_cumsum(lines, ["_file", "_piece", "_row"], "_line", "seq").select("value", "seq")


def write_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = False) -> DataFrame:
    """Results as ``sep``-separated text (times as ``yyyy-MM-dd HH:mm:ss``); returns the read-back."""
    (df.write.mode("overwrite").option("sep", sep).option("header", header)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .csv(path))
    return (df.sparkSession.read.option("sep", sep).option("header", header)
            .schema(", ".join(f"`{c}` string" for c in df.columns)).csv(path))


def append_run_stats(stats: DataFrame, path: str, source: str = "source") -> DataFrame:
    """A6 sink: run statistics (``parse_run_stats`` rows with their source) appended to a table kept per source; returns the table.

    The table is partitioned by source, so one source's runs are appended and read without touching the others'."""
    stats.write.mode("append").partitionBy(source).parquet(path)
    return stats.sparkSession.read.schema(stats.schema).parquet(path).select(*stats.columns)

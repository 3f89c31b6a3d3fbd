"""Text forms of rows: listing lines, version-store names, change-log lines.

These are the inverses of the parsers in ``sources.parsers``; the registered
queries render lines from the given tables and parse them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import fmt_time, show_deleted

# Separator between valid-from and valid-to in a version name,
# and the 12-character operation codes of an itemized sync log.
TIME_SEP = "~"
OP_NEW_DIR = "cd+++++++++ "
OP_NEW_FILE = ">f+++++++++ "
OP_DELETING = "*deleting   "


def version_name(created="created", deleted="deleted", sep: str = TIME_SEP) -> Column:
    """``<created>~<deleted>`` with ``now`` for open versions."""
    return F.concat(fmt_time(created), F.lit(sep), show_deleted(deleted))


def format_version_path(h: DataFrame, sep: str = TIME_SEP) -> DataFrame:
    """A4: ``dirname||filename/created~deleted`` for every version."""
    return h.select("inode", "type", "dirname", "filename",
                    F.concat("dirname", "filename", F.lit("/"), version_name(sep=sep)).alias("store_path"))


def listing_lines(inv: DataFrame) -> DataFrame:
    """``inode type dir/name`` lines (the listing format)."""
    return inv.select(F.concat_ws(" ", F.col("inode").cast("string"), "type",
                                  F.concat("dirname", "filename")).alias("value"))


def store_lines(h: DataFrame, sep: str = TIME_SEP) -> DataFrame:
    """``inode type dir/name/created~deleted`` lines (a version-store listing)."""
    p = format_version_path(h, sep)
    return p.select(F.concat_ws(" ", F.col("inode").cast("string"), "type", "store_path").alias("value"))


def change_lines(changes: DataFrame) -> DataFrame:
    """Itemized sync-log lines from (seq, op, path)."""
    code = (F.when(F.col("op") == "new_dir", F.lit(OP_NEW_DIR))
            .when(F.col("op") == "new_file", F.lit(OP_NEW_FILE))
            .otherwise(F.lit(OP_DELETING)))
    return changes.select("seq", F.concat(code, "path").alias("value"))


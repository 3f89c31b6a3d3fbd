"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare, scratch_path

#: Text handed to numpy at once inside a task; bounds the memory of a worker whatever the batch size.
CHUNK_BYTES = 4 << 20
#: A sieve of keys has 2 to this power bits, in words of 64: at most 65,536 rows, whatever the input.
SIEVE_BITS = 22
#: What Spark holds at once of a table on its way to a worker. Its defaults are 64 MB and 4,096 rows, however long, and a column of a
#: row group read as one piece through buffers outside of the heap, which the reading threads then keep.
BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    "parquet.hadoop.vectored.io.enabled": "false",
}
#: Row groups of intermediate tables: whoever writes or reads a file holds one of them.
ROW_GROUP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(prepare(spark))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def short_batches(spark: SparkSession) -> SparkSession:
    """Bound what an executor and its workers hold of long texts at once; results do not depend on it."""
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    return spark


def held_out(id_col: str | Column = "doc_id") -> Column:
    """True for the rows that no classifier may learn from: crc32 of the id as text, modulo 4, is 2."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def stored(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write to the shared folder and read back: computed once, and independent of the executors that made it.

    ``few``: in two files a core at most, for tables far smaller than the input. Every file costs its executor two new processes (the
    local file system sets the permissions of a file and its checksum by ``chmod``), which count as large as the executor until they start."""
    path = scratch_path(df.sparkSession, name)
    if few:
        df = df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)  # shuffle partitions of a task one after the other
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``stored``, each task's rows in files by a hash of ``key``: what groups or joins by it reads them without a shuffle.

    Spark reads buckets through its catalog only, so the files (in the shared folder) are registered under a fresh name, which is
    given back at once: the frame keeps its own list of them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table_name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table_name)
    out = spark.table(table_name)
    out.schema  # resolved now, while the name is registered
    spark.sql(f"DROP TABLE {table_name}")
    return out


def sieved(df: DataFrame, keys: DataFrame, key: str, bits: int = SIEVE_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is certainly not among those of ``keys``, all other rows): exact joins need the second part only.

    The hashes of the keys mark bits of a table of fixed size, which is broadcast; rows on a marked bit are in the second part, those
    that hold no such key among them. So long rows that a few keys do not concern are not shuffled to learn that."""
    at = F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1))
    words = (keys.select(at.alias("_sieve_at")).groupBy(F.shiftright("_sieve_at", 6).alias("_sieve_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(_sieve_at & 63))")).alias("_sieve_bits")))
    marked = df.withColumn("_sieve_at", at)
    marked = marked.join(F.broadcast(words), F.shiftright("_sieve_at", 6) == F.col("_sieve_word"), "left")
    hit = F.expr("coalesce(shiftright(_sieve_bits, int(_sieve_at & 63)) & 1, 0) = 1")
    return marked.where(~hit).select(*df.columns), marked.where(hit).select(*df.columns)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Split a batch into row ranges of about ``limit`` bytes of text (a longer text stands alone)."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    at = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < n:
        before = int(at[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(at, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end



"""Vectors as exact integers, for the operators whose contracts round components down (11 and 13)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit(dim: int) -> int:
    """The largest component for which inner products and squared distances of vectors of this length are exact in a double."""
    return int((2.0 ** 51 / max(1, dim)) ** 0.5)


def integer_vectors(df: DataFrame, scale: int, keep: tuple[str, ...] = (), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x, dim) and ``keep``: every component is floor(scale * component), computed in double precision.

    Rows with a null id, a null or empty vector, or a null or non-finite component are left out, and so are those with a
    component beyond ``limit(dim)``, whose sums no longer fit the contract's integer types."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double") * scale)
    out = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("_x"), *keep).where("vec_id IS NOT NULL AND size(_x) > 0")
    most = F.lit(2.0 ** 51) / F.size("_x")
    fine = F.forall("_x", lambda v: F.coalesce(~F.isnan(v) & (v * v < most), F.lit(False)))
    return out.where(fine).select("vec_id", F.transform("_x", lambda v: F.floor(v).cast("int")).alias("x"), F.size("_x").alias("dim"), *keep)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in chunks]
    return np.concatenate(flat).reshape(-1, dim).astype(np.int64) if flat else np.empty((0, dim), np.int64)

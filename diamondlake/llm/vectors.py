"""Vectors as rows: which take part, and how tasks see them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part: an id, and a finite vector with no NULL that is not zero.

    The dimension is the most frequent one (the larger of equally frequent); vectors
    of another length take no part.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & good)
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).select("d")
    return rows.where(F.size("v") == usual.scalar())


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def hashed_sample(rows: DataFrame, size: int) -> DataFrame:
    """About ``size`` rows at most, those whose ids have the smallest hashes."""
    part = min(1.0, size / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(part * (1 << 20)))

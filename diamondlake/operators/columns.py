"""Checks and layout of columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail before any plan is built when a needed column is absent."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def order_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Known columns in the given order, absent ones skipped, others after them."""
    known = [c for c in first if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in first])


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as DOUBLE, NULL when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent_of_total(counted: DataFrame, out: str) -> DataFrame:
    """Percent of ``n`` in the sum over all (grouped) rows, which is one row and broadcast."""
    one = F.lit(1)
    total = counted.agg(F.sum("n").alias("__total")).withColumn("__one", one)
    both = counted.withColumn("__one", one).join(F.broadcast(total), "__one")
    return both.select(*counted.columns, (ratio(F.col("n"), F.col("__total")) * 100).alias(out))

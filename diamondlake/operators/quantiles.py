"""Exact ranks and quantiles without a single-task sort.

Equal values are counted first, so ties of any size become one row, and written once. Ranks
come from a sample sort of the distinct values: ranges of about equal size. For quantiles per
key the distinct values fall into value ranges given by a fixed monotone formula, at most about
90,000 of them for any doubles; a quantile looks only into the one or two ranges that hold it.
Only the ranges' totals meet in one window: it tells how many rows lie below a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.operators.materialize import materialize

# Non-decreasing in the value; about 64 ranges per power of e, fine near zero.
_RANGE = "floor(signum({0}) * log1p(abs({0}) * 1048576) * 64)"

# Distinct values in a range of the sample sort, about.
RANGE_ROWS = 250_000

QUARTILES = (0.25, 0.5, 0.75)
QUARTILE_NAMES = ("q25", "q50", "q75")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key and distinct value (NULL included) its count ``n``, kept in the checkpoint folder.

    The rows are read once here; everything after works on the counts.
    """
    return materialize(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")))


def _ranges(counts: DataFrame, keys: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Counts of the known values with their range, and per range its ``rows`` and the rows ``below`` it."""
    ranged = counts.where(F.col(value).isNotNull()).withColumn("__range", F.expr(_RANGE.format(value)))
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return ranged, sums.withColumn("below", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def _inside(ranged: DataFrame, sums: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Counts of the ranges in ``sums`` with ``upto``, the number of rows up to each value."""
    to_here = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = [*keys, "__range"]
    entering = sums.select(*[F.col(c).alias(f"__of_{c}") for c in at], "below")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in at])
    met = ranged.join(entering, same).drop(*[f"__of_{c}" for c in at])
    return met.withColumn("upto", F.col("below") + F.sum("n").over(to_here)).drop("below", "__range")


def value_ranks(counts: DataFrame, value: str, range_rows: int = RANGE_ROWS, at_most: int | None = None) -> DataFrame:
    """Counts of the known values with ``upto``, the number of rows up to each value.

    A sample sort: the planner's range partitioning draws splitters from a sample of the
    distinct values, so a range holds about ``range_rows`` of them however the values are
    spread. The ranges are written, which fixes them; prefix sums over the ranges' totals
    tell what lies below a range, a window inside it the rest. ``at_most`` bounds the
    number of distinct values where it is known, else they are counted.
    """
    known = counts.where(F.col(value).isNotNull())
    n_ranges = max(1, -(-(known.count() if at_most is None else at_most) // range_rows))
    ranged = materialize(known.repartitionByRange(n_ranges, value).withColumn("__range", F.spark_partition_id()))
    sums = ranged.groupBy("__range").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    entering = sums.select(F.col("__range").alias("__of"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("below"))
    to_here = Window.partitionBy("__range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = ranged.join(entering, F.col("__range") == F.col("__of"))
    return met.withColumn("upto", F.col("below") + F.sum("n").over(to_here)).drop("__of", "below", "__range")


def average_ranks(counts: DataFrame, value: str, out: str, at_most: int | None = None) -> DataFrame:
    """Rank of each distinct value, ties sharing the mean rank."""
    ranked = value_ranks(counts, value, at_most=at_most)
    return ranked.select(value, (F.col("upto") - (F.col("n") - 1) / 2.0).alias(out))


def describe(
    df: DataFrame, keys: Sequence[str], value: str,
    points: Sequence[float] = QUARTILES, names: Sequence[str] = QUARTILE_NAMES,
) -> DataFrame:
    """count, missing, mean, std (n-1), min, quantiles, max; one row per key.

    Quantiles interpolate linearly: the sorted row at 0-based place ``p`` lies in
    the distinct value with ``upto - n <= p < upto``, and a point needs the rows
    around ``q * (rows - 1)``.
    """
    counts = value_counts(df.select(*keys, F.col(value).cast("double").alias("__v")), keys, "__v")
    v, n = F.col("__v"), F.col("n")
    totals = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(v.isNotNull(), n)), F.lit(0)).alias("__rows"),
        F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("__missing"),
        F.sum(v * n).alias("__sum"), F.min(v).alias("__min"), F.max(v).alias("__max"),
    )
    totals = totals.withColumn("__mean", F.try_divide("__sum", "__rows"))
    on = [*keys, "__one"]
    totals = totals.withColumn("__one", F.lit(1))
    counts = counts.withColumn("__one", F.lit(1))
    mean = totals.select(*[F.col(c).alias(f"__of_{c}") for c in on], "__mean", "__rows")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in on])

    def with_totals(rows: DataFrame) -> DataFrame:
        return rows.join(mean, same).drop(*[f"__of_{c}" for c in on])

    def spot(q: float) -> Column:
        return F.lit(q) * (F.col("__rows") - 1)

    def holds(low: Column, high: Column, place: Column) -> Column:
        return (low <= place) & (place < high)

    ranged, sums = _ranges(counts, on, "__v")
    places = [place(spot(q)) for q in points for place in (F.floor, F.ceil)]
    asked = [holds(F.col("below"), F.col("below") + F.col("rows"), place) for place in places]
    chosen = with_totals(sums).where(reduce(lambda a, b: a | b, asked)).drop("__mean", "__rows")
    placed = with_totals(_inside(ranged, chosen, on, "__v"))
    exprs = []
    for q, name in zip(points, names):
        for side, place in (("low", F.floor(spot(q))), ("high", F.ceil(spot(q)))):
            exprs.append(F.max(F.when(holds(F.col("upto") - n, F.col("upto"), place), v)).alias(f"__{side}_{name}"))
        exprs.append(F.max(spot(q) - F.floor(spot(q))).alias(f"__part_{name}"))
    squares = with_totals(counts).groupBy(*on).agg(F.sum(n * (v - F.col("__mean")) ** 2).alias("__squares"))
    parts = squares.join(_renamed_keys(placed.groupBy(*on).agg(*exprs), on), same, "left").drop(*[f"__of_{c}" for c in on])
    found = totals.join(_renamed_keys(parts, on), same, "left").drop(*[f"__of_{c}" for c in on])
    deviation = F.when(F.col("__rows") > 1, F.sqrt(F.col("__squares") / (F.col("__rows") - 1)))
    mixed = [
        (F.col(f"__low_{m}") + (F.col(f"__high_{m}") - F.col(f"__low_{m}")) * F.col(f"__part_{m}")).alias(m)
        for m in names
    ]
    return found.select(
        *keys, F.col("__rows").alias("n"), F.col("__missing").alias("missing"), F.col("__mean").alias("mean"),
        deviation.alias("std"), F.col("__min").alias("min"), *mixed, F.col("__max").alias("max"),
    )


def _renamed_keys(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    return rows.withColumnsRenamed({c: f"__of_{c}" for c in on})

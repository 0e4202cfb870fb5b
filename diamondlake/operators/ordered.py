"""Ordered computations inside a key (a game, a pitcher in a game, ...).

Every function here has two plans with the same result:

* ``width is None``: one ordinary window per key. All functions partitioned by
  the same key share a single exchange. Right for keys of ordinary size.
* ``width`` given: the key is cut into chunks along its order. Windows run per
  chunk, each chunk leaves one summary row, a window over the summaries gives
  what enters the chunk from before (or after), and a join on (key, chunk) adds
  it. No task ever holds a whole key, however large the key is.

``find_hot`` decides which keys need the second plan and ``by_size`` applies it
to those keys only. Split once, around a whole chain of steps: inside, every step
takes the same ``width``. A step of the second plan reads its input twice, hence
it first writes it to the checkpoint folder, which keeps long chains linear.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.operators.materialize import materialize

HOT_LIMIT = 200_000
CHUNK_WIDTH = 50_000
# Rows of a task, about. The sorts of a chain take a kilobyte a row together.
TASK_ROWS = 200_000


@dataclass(frozen=True)
class Order:
    """Rows of each ``keys`` value, ordered by ``by``.

    The chunk of a row is ``chunk`` or, by default, the leading order columns
    and the last one divided by ``width``. The last one is an integer that is
    unique below the leading ones, hence a chunk has at most ``width`` rows.
    A chunk expression must never decrease along the order.
    """

    keys: tuple[str, ...]
    by: tuple[str, ...]
    width: int | None = None
    chunk: tuple[str, ...] | None = None

    def chunk_columns(self) -> dict[str, Column]:
        parts = self.chunk
        if parts is None:
            parts = (*self.by[:-1], f"floor({self.by[-1]} / {self.width})")
        return {f"__chunk{i}": F.expr(part) for i, part in enumerate(parts)}

    def plus_key(self, name: str) -> Order:
        return Order((*self.keys, name), self.by, self.width, self.chunk)


def find_hot(df: DataFrame, key: str, limit: int = HOT_LIMIT) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None. One narrow, map-side combined pass; written only where there are some."""
    hot = df.groupBy(key).count().where(F.col("count") > limit).select(key)
    return None if hot.isEmpty() else materialize(hot)


def by_size(
    df: DataFrame, hot: DataFrame | None, key: str, width: int, run: Callable[[DataFrame, int | None], DataFrame]
) -> DataFrame:
    """Apply ``run(rows, None)`` to ordinary keys and ``run(rows, width)`` to hot ones."""
    return union([run(rows, w) for rows, w in branches(df, hot, key, width)])


def branches(
    df: DataFrame, hot: DataFrame | None, key: str, width: int = CHUNK_WIDTH
) -> list[tuple[DataFrame, int | None]]:
    """Rows of ordinary keys, and those of hot keys with the chunk width to use."""
    if hot is None:
        return [(df, None)]
    named = hot.select(F.col(key).alias("__hot"))
    same = F.col(key).eqNullSafe(F.col("__hot"))
    return [(df.join(named, same, "left_anti"), None), (df.join(named, same, "left_semi"), width)]


def deal(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in so many partitions that one holds about ``TASK_ROWS`` of its ``rows``.

    The number is given: the adaptive planner folds partitions by their compressed
    bytes, of which a sort in memory takes many times as much, and the number it
    starts from does not grow with the input.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *keys)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def running(df: DataFrame, out: str, value: Column, order: Order, kind: str = "sum") -> DataFrame:
    """Running ``sum`` or ``max`` of a value from the start of the key to the row."""
    combine = {"sum": F.sum, "max": F.max}[kind]
    to_here = (Window.unboundedPreceding, Window.currentRow)
    if order.width is None:
        window = Window.partitionBy(*order.keys).orderBy(*order.by).rowsBetween(*to_here)
        return df.withColumn(out, combine(value).over(window))
    chunks = order.chunk_columns()
    rows = materialize(df.withColumns(chunks).withColumn("__value", value))
    window = Window.partitionBy(*order.keys, *chunks).orderBy(*order.by).rowsBetween(*to_here)
    local = rows.withColumn("__local", combine("__value").over(window))
    totals = rows.groupBy(*order.keys, *chunks).agg(combine("__value").alias("__total"))
    before = Window.partitionBy(*order.keys).orderBy(*chunks).rowsBetween(Window.unboundedPreceding, -1)
    entering = _renamed(totals, order.keys, chunks, combine("__total").over(before).alias("__entering"))
    both = _join_chunks(local, entering, order.keys, chunks)
    if kind == "sum":
        result = F.coalesce("__local", F.lit(0)) + F.coalesce("__entering", F.lit(0))
    else:
        result = F.greatest("__local", "__entering")
    return both.select(*df.columns, result.alias(out))


def position(df: DataFrame, out: str, order: Order) -> DataFrame:
    """1-based position of the row inside its key."""
    return running(df, out, F.lit(1).cast("bigint"), order)


def neighbour(df: DataFrame, columns: dict[str, str], order: Order, step: int) -> DataFrame:
    """Values of the previous (``step=-1``) or next (``step=1``) row of the key."""
    shift = F.lag if step < 0 else F.lead
    if order.width is None:
        window = Window.partitionBy(*order.keys).orderBy(*order.by)
        return df.withColumns({out: shift(source).over(window) for out, source in columns.items()})
    chunks = order.chunk_columns()
    row = F.struct(*[F.col(source).alias(out) for out, source in columns.items()])
    rows = materialize(df.withColumns(chunks).withColumn("__row", row))
    window = Window.partitionBy(*order.keys, *chunks).orderBy(*order.by)
    local = rows.withColumn("__local", shift("__row").over(window))
    edge = (F.max_by if step < 0 else F.min_by)(F.col("__row"), F.struct(*order.by))
    edges = rows.groupBy(*order.keys, *chunks).agg(edge.alias("__edge"))
    across = Window.partitionBy(*order.keys).orderBy(*chunks)
    entering = _renamed(edges, order.keys, chunks, shift("__edge").over(across).alias("__entering"))
    both = _join_chunks(local, entering, order.keys, chunks)
    found = both.withColumn("__found", F.coalesce("__local", "__entering"))
    return found.select(*df.columns, *[F.col("__found")[out].alias(out) for out in columns])


def rolling_mean(df: DataFrame, out: str, value: str, order: Order, size: int) -> DataFrame:
    """Mean of the last ``size`` known values up to the row; NULL where the value is NULL."""
    known = df.withColumn("__known", F.col(value).isNotNull())
    order = order.plus_key("__known")
    if order.width is None:
        window = Window.partitionBy(*order.keys).orderBy(*order.by).rowsBetween(1 - size, 0)
        return known.withColumn(out, F.avg(value).over(window)).drop("__known")
    # Equal blocks by position; the last size-1 rows of a block are also sent to
    # the next block, where they only serve as history.
    width = max(order.width, size)
    ranked = position(known, "__position", order)
    ranked = ranked.withColumn("__block", F.floor((F.col("__position") - 1) / width))
    late = (F.col("__position") - 1) % width >= width - (size - 1)
    copies = F.when(late, F.array(F.col("__block"), F.col("__block") + 1)).otherwise(F.array("__block"))
    sent = ranked.withColumn("__target", F.explode(copies))
    window = Window.partitionBy(*order.keys, "__target").orderBy("__position").rowsBetween(1 - size, 0)
    meaned = sent.withColumn(out, F.avg(value).over(window))
    return meaned.where(F.col("__target") == F.col("__block")).select(*df.columns, out)


def key_minimum(df: DataFrame, out: str, value: Column, keys: Sequence[str], width: int | None = None) -> DataFrame:
    """Smallest value of the key on each of its rows."""
    if width is None:
        return df.withColumn(out, F.min(value).over(Window.partitionBy(*keys)))
    df = materialize(df)
    least = df.groupBy(*keys).agg(F.min(value).alias(out))
    return df.join(least, list(keys), "left")


def _renamed(df: DataFrame, keys: Sequence[str], chunks: dict[str, Column], value: Column) -> DataFrame:
    names = [*keys, *chunks]
    return df.select(*[F.col(name).alias(f"__right_{name}") for name in names], value)


def _join_chunks(left: DataFrame, right: DataFrame, keys: Sequence[str], chunks: dict[str, Column]) -> DataFrame:
    equal = [F.col(name).eqNullSafe(F.col(f"__right_{name}")) for name in (*keys, *chunks)]
    return left.join(right, reduce(lambda a, b: a & b, equal), "left")

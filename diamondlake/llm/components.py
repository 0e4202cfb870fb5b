"""Connected components by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.operators.materialize import materialize


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(id, component) for every id of the links (a, b): the smallest id reachable.

    Each round hangs larger neighbours, then smaller ones, below the smallest
    neighbour (map-side combined minima and one join, whose hot hubs the adaptive
    planner splits), until every id hangs directly below its component's smallest.
    NULL ids and links of an id with itself are ignored.
    """
    edges = materialize(_down(links.select("a", "b")))
    for _ in range(max_rounds):
        if _is_star(edges):
            break
        edges = materialize(_small_star(materialize(_large_star(edges))))
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots).distinct()


def _down(links: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller id."""
    return links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether every upper end has one lower end and no lower end is an upper end."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    wrong = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return wrong.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of an id goes below the smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    up = both.where(F.col("v") > F.col("u")).join(least, "u")
    return _down(up.select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of an id, and the id itself, goes below the smallest one."""
    least = materialize(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.union(least.select("a", F.col("m").alias("b"))))


def spanning_forest(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of the pairs that join two parts not joined by earlier pairs, within one task."""
    root: dict[int, int] = {}
    keep = []

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(k)
    return np.array(keep, dtype=np.int64)

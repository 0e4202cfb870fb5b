"""Near-duplicate embeddings by collision counting over one-dimensional projections.

Unit vectors are projected on many random directions. Two vectors of a given cosine
differ by a normal deviate of known width in each projection, so the number of
projections in which one lies in a window centred on the other tells near pairs from
others. A cosine test is spent only on pairs whose count reaches a threshold that a
pair at the limit passes with a given recall.

Distribution: projections come in groups; the cells of a group of ``group`` grids with
random offsets bring together what collides in all of them, and enough groups are used
that a pair at the limit shares a cell with the wanted recall. Within a cell the
counting projections are sorted, and the window of each vector is found by binary
search. Cells meet in blocks of bounded size. A pair counts in the first group in
which it shares a cell, so counts need no list of pairs; what leaves a block is one
number per vector and one spanning forest.

Equal vectors are one class from the start and are never compared with each other.

Defined results: ids that are NULL are left out; vectors that are NULL, zero, hold NULL
or non-finite numbers or have an unusual length link with nothing; an id that occurs
twice is judged per row and counts as another vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, erf, exp, log, pi, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diamondlake.llm.arrow_groups import changes, whole_groups
from diamondlake.llm.byte_words import mix
from diamondlake.llm.components import components, spanning_forest
from diamondlake.llm.vectors import matrix, usable
from diamondlake.operators.materialize import materialize

BLOCK = 256


@dataclass(frozen=True)
class Plan:
    """Sizes that follow from the threshold and the wanted recall."""

    threshold: float
    group: int
    recall: float = 0.9995
    width: float = 6.0
    counting: int = 64
    window: float = 2.0

    @classmethod
    def for_rows(cls, rows: int, threshold: float, recall: float) -> Plan:
        """Grids per group, so many that ``rows`` unrelated vectors share a cell with a tenth of another one."""
        probe = cls(threshold, 1, recall)
        # Unrelated unit vectors differ as a pair of cosine 0 does.
        w = probe.width * probe.spread / sqrt(2)
        return cls(threshold, max(4, ceil(log(max(2, rows) / 0.1) / -log(cls.same_cell(w)))), recall)

    @staticmethod
    def same_cell(w: float) -> float:
        """Probability that two points share a cell of ``w`` standard deviations of their difference."""
        return erf(w / sqrt(2)) - sqrt(2 / pi) / w * (1 - exp(-w * w / 2))

    @property
    def spread(self) -> float:
        """Standard deviation of a pair at the limit along a direction of unit normal components."""
        return sqrt(2 - 2 * self.threshold)

    @property
    def groups(self) -> int:
        """How many groups until a pair at the limit shares a cell with the wanted recall."""
        return ceil(log(1 - self.recall) / log(1 - self.same_cell(self.width) ** self.group))

    @property
    def least_count(self) -> int:
        """Window collisions that a pair at the limit reaches with the wanted recall."""
        p = erf(self.window / sqrt(2))
        deviation = sqrt(self.counting * p * (1 - p))
        return max(0, int(self.counting * p - NormalDist().inv_cdf(self.recall) * deviation) - 1)

    def directions(self, dimension: int, n: int, seed: int) -> np.ndarray:
        return np.random.default_rng(seed).standard_normal((dimension, n))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow for very large or small numbers."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cell_keys(x: np.ndarray, plan: Plan) -> np.ndarray:
    """One 64-bit key per vector and group: the cells of its grids, hashed together."""
    n = plan.groups * plan.group
    step = plan.width * plan.spread
    offset = np.random.default_rng(5).random(n) * step
    cell = np.floor((x @ plan.directions(x.shape[1], n, 3) + offset) / step).astype(np.int64).astype(np.uint64)
    cell = mix(cell + np.arange(n, dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15)).reshape(len(x), plan.groups, plan.group)
    return mix(cell.sum(axis=2, dtype=np.uint64)).astype(np.int64)


def window_counts(projected: np.ndarray, cell: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, count) for the pairs of rows of one cell: in how many columns the windows meet.

    ``cell`` ascends. Every column is sorted within the cells; the end of the window
    centred on a row is found by binary search, and the rows up to it are counted.
    """
    n = len(cell)
    size = np.bincount(cell)
    first = np.cumsum(size) - size
    slot = np.cumsum(size * size) - size * size
    place = np.arange(n) - first[cell]
    counts = np.zeros(int((size * size).sum()), dtype=np.int32)
    reach = np.abs(projected).max(initial=0.0) + half
    for column in projected.T:
        spot = cell * (4 * reach) + column
        order = np.argsort(spot, kind="stable")
        stop = np.searchsorted(spot[order], spot[order] + half, side="right")
        stop = np.minimum(stop, (first + size)[cell[order]])
        met = stop - np.arange(n) - 1
        left = np.repeat(order, met)
        right = order[np.repeat(np.arange(n) + 1 - (np.cumsum(met) - met), met) + np.arange(met.sum())]
        low, high = np.minimum(place[left], place[right]), np.maximum(place[left], place[right])
        counts += np.bincount(slot[cell[left]] + low * size[cell[left]] + high, minlength=len(counts)).astype(np.int32)
    found = np.flatnonzero(counts)
    at = np.searchsorted(slot, found, side="right") - 1
    inside = found - slot[at]
    return first[at] + inside // size[at], first[at] + inside % size[at], counts[found]


def linked_pairs(x: np.ndarray, cell: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one cell whose window count passes and whose exact cosine reaches the threshold."""
    left, right, count = window_counts(x @ plan.directions(x.shape[1], plan.counting, 4), cell, plan.window * plan.spread)
    keep = count >= plan.least_count
    left, right = left[keep], right[keep]
    near = np.zeros(len(left), dtype=bool)
    for at in range(0, len(left), 100_000):
        part = slice(at, at + 100_000)
        near[part] = np.einsum("ij,ij->i", x[left[part]], x[right[part]]) >= plan.threshold
    return left[near], right[near]


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, recall: float = 0.9995, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per row: id, n_links (other rows linked directly), component_id (smallest id reachable), kept."""
    rows = usable(vectors, id_col, vector_col)
    kind = rows.schema["v"].dataType.simpleString()
    # Equal vectors are one class with its size.
    classes = materialize(rows.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    plan = Plan.for_rows(classes.count(), threshold, recall)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                found = cell_keys(unit(matrix(batch.column(1))), plan)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, plan.groups), pa.int32()), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "keys"])

    keyed = classes.select("id", "v").mapInArrow(keys, "id long, keys array<long>")
    keyed = keyed.select("id", F.posexplode("keys").alias("part", "key"))
    shared = materialize(keyed.groupBy("part", "key").agg(F.count("*").alias("in_cell")).where(F.col("in_cell") > 1))
    members = keyed.join(shared, ["part", "key"]).join(classes, "id")
    # A large cell is cut into blocks; every block meets every other one.
    blocks = F.ceil(F.col("in_cell") / BLOCK)
    members = members.withColumn("own", F.pmod(F.xxhash64("id", "part"), blocks))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    members = members.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("other", "in_cell")
    meeting = ["part", "key", "x", "y"]

    def solve(table: pa.Table) -> pa.RecordBatch:
        """Per vector its links in these blocks (b = -1), and a spanning forest of the links (n = 0)."""
        ids, copies, own, part = (table[c].to_numpy() for c in ("id", "copies", "own", "part"))
        x = unit(matrix(table["v"]))
        left, right = linked_pairs(x, np.cumsum(changes(table, meeting)) - 1, plan)
        # Blocks that meet themselves count their inner pairs.
        keep = (own[left] != own[right]) | (table["x"].to_numpy() == table["y"].to_numpy())[left]
        left, right = left[keep], right[keep]
        if len(left):
            # A pair counts in the first group in which it shares a cell.
            some = np.unique(np.concatenate([left, right]))
            cells, back = cell_keys(x[some], plan), np.searchsorted(some, np.arange(len(x)))
            first = np.empty(len(left), dtype=np.int64)
            for at in range(0, len(left), 50_000):
                s = slice(at, at + 50_000)
                first[s] = np.argmax(cells[back[left[s]]] == cells[back[right[s]]], axis=1)
            keep = first == part[left]
            left, right = left[keep], right[keep]
        links = np.bincount(left, weights=copies[right], minlength=len(ids)) + np.bincount(right, weights=copies[left], minlength=len(ids))
        counted, forest = np.flatnonzero(links), spanning_forest(left, right)
        a = np.concatenate([ids[counted], ids[left[forest]]])
        b = np.concatenate([np.full(len(counted), -1), ids[right[forest]]])
        n = np.concatenate([links[counted].astype(np.int64), np.zeros(len(forest), dtype=np.int64)])
        return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(solve, whole_groups(batches, meeting, 4_000))

    dealt = members.repartition(*meeting).sortWithinPartitions(*meeting)
    found = materialize(dealt.mapInArrow(run, "a long, b long, n long"))
    counts = found.where(F.col("n") > 0).groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    joined = components(found.where(F.col("n") == 0).select("a", "b"))
    of_class = classes.join(counts, "id", "left").join(joined, "id", "left").select(
        F.col("v").alias("__v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", F.col("id")).alias("component_id"),
    )
    every = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    judged = every.join(materialize(of_class), (F.col("v") == F.col("__v")) & F.col("id").isNotNull(), "left")
    return judged.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))

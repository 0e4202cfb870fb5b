"""Nearest neighbours and near-duplicate vectors against brute force."""

import math
import random

import numpy as np
import pytest
from frames import joined
from pyspark.sql import functions as F

from diamondlake.llm import collision_counting, multi_index

SCHEMA = "vec_id long, embedding array<float>, id string, v string, n long"
ODD = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [math.nan] + [1.0] * 7, [math.inf] + [1.0] * 7, [1.0, 2.0]]


def vector_rows(seed=1, groups=6, size=40):
    """Groups of near copies, exact copies, unrelated and odd vectors, a repeated row, one without id."""
    rng = np.random.default_rng(seed)
    x = [c + rng.normal(0, 0.03, 8) for c in rng.normal(0, 1, (groups, 8)) for _ in range(size)]
    x += [*rng.normal(0, 1, (80, 8)), x[0], x[0], x[5] * 3.0]
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)] + [(1000 + i, v) for i, v in enumerate(ODD)]
    random.Random(seed).shuffle(rows)
    return rows + [rows[3], (None, rows[4][1])]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", 1) for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and len(v) == 8 and all(a is not None and math.isfinite(a) for a in v) and any(v)


@pytest.mark.parametrize("block", [512, 16])
def test_search(spark, monkeypatch, block):
    """With every cell visited the answer is exact, in blocks of any size."""
    monkeypatch.setattr(multi_index, "ROW_BLOCK", block)
    monkeypatch.setattr(multi_index, "QUERY_BLOCK", 3)
    rows = vector_rows()
    index = multi_index.MultiIndex(vectors(spark, rows), centroids=6)
    found = multi_index.search(index, index.rows.where(F.col("id") % 20 == 0), k=5, share=1.0).collect()
    good = {i: np.array(v) for i, v in rows if i is not None and usable(v)}
    queries = [i for i in good if i % 20 == 0]
    assert len(found) == 5 * len(queries)
    for q in queries:
        want = sorted((math.sqrt(((good[q] - v) ** 2).sum()), i) for i, v in good.items() if i != q)[:5]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [g[1] for g in got] == [i for _, i in want] and np.allclose([g[2] for g in got], [d for d, _ in want], atol=1e-12)


def test_search_small(spark):
    index = multi_index.MultiIndex(vectors(spark, [(0, [1.0] * 8), (1, [2.0] * 8), (2, None)]))
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in multi_index.search(index, index.rows.where("id = 0")).collect()] == [(0, 1, 1)]
    none = multi_index.MultiIndex(vectors(spark, []))
    assert multi_index.search(none, none.rows).count() == 0


def test_walk():
    """Cells come in the order of their summed distance and stop at the wanted number."""
    rng = np.random.default_rng(2)
    a, b, size = rng.random(7), rng.random(5), rng.integers(0, 4, (7, 5))
    cells = multi_index.walk_cells(a, b, size, 1 << 40)
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and len(cells) == (size > 0).sum()
    part = multi_index.walk_cells(a, b, size, 9)
    assert part == cells[: len(part)] and sum(size[i, j] for i, j in part[:-1]) < 9 <= sum(size[i, j] for i, j in part)


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(collision_counting, "BLOCK", block)
    rows = vector_rows()
    got = collision_counting.near_duplicates(vectors(spark, rows)).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if i is not None and usable(v)]
    u = np.array([v for _, v in good])
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    ids = [i for i, _ in good]
    want = joined(set(ids), [(ids[a], ids[b]) for a, b in zip(*np.nonzero(link)) if ids[a] != ids[b]])
    count = {i: n for i, n in zip(ids, link.sum(1))}
    for r in got:
        i = r["vec_id"]
        assert (r["n_links"], r["component_id"], r["kept"]) == (count.get(i, 0), want.get(i, i), want.get(i, i) == i)


def test_window_counts():
    rng = np.random.default_rng(4)
    cell = np.sort(rng.integers(0, 6, 60))
    cell = np.unique(cell, return_inverse=True)[1]
    projected = rng.normal(0, 1, (60, 9))
    left, right, count = collision_counting.window_counts(projected, cell, 0.4)
    want = {(a, b): n for a in range(60) for b in range(a + 1, 60)
            if cell[a] == cell[b] and (n := int((np.abs(projected[a] - projected[b]) <= 0.4).sum()))}
    assert dict(zip(zip(left.tolist(), right.tolist()), count.tolist())) == want


def test_plan():
    plan = collision_counting.Plan.for_rows(50_000, 0.95, 0.9995)
    assert (1 - (1 - plan.same_cell(plan.width) ** plan.group) ** plan.groups) >= plan.recall and 0 < plan.least_count < plan.counting
    assert collision_counting.Plan.for_rows(10**9, 0.95, 0.9995).group > plan.group


def test_near_duplicates_empty(spark):
    assert collision_counting.near_duplicates(vectors(spark, [])).count() == 0

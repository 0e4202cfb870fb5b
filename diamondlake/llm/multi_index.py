"""Approximate nearest neighbours with an inverted multi-index.

Both halves of a vector are quantised on their own, so ``centroids`` squared cells
come from two small codebooks. A query walks through the cells by the sum of its two
squared centroid distances, with a heap over pairs, until the cells it has met hold a
given share of all different vectors; all entries of those cells are reranked by exact
distance. Codebooks are fitted on a bounded sample; every row is indexed.

Distribution: rows and queries meet per first-half centroid, cut into blocks of rows
and blocks of queries of bounded size, so no task holds a whole hot cell. A block
returns its ten best per query; a last small window merges them.

Defined results: ids that are NULL and vectors that are NULL, zero, hold NULL or
non-finite numbers or have an unusual length take no part; a repeated id counts once,
with its nearest vector, and is never its own neighbour; fewer than k candidates give
fewer rows; an empty table gives none. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from diamondlake.llm.vectors import hashed_sample, matrix, usable
from diamondlake.operators.materialize import materialize

#: Bounds of what the codebooks are fitted on, and of the blocks that meet.
SAMPLE_ROWS = 20_000
ROW_BLOCK = 512
QUERY_BLOCK = 1_024


def fit_codebook(x: np.ndarray, k: int, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm from distinct random rows."""
    x = np.unique(x, axis=0)
    centre = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        near = nearest(x, centre)
        total, n = np.zeros_like(centre), np.bincount(near, minlength=len(centre))
        np.add.at(total, near, x)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of every row; a single component is its own two halves."""
    half = max(1, x.shape[1] // 2)
    return x[:, :half], x[:, half:] if x.shape[1] > 1 else x


def squared(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (centre * centre).sum(1)[None] - 2 * x @ centre.T


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin(squared(x, centre), axis=1)


def walk_cells(first: np.ndarray, second: np.ndarray, size: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Cells by summed distance until their sizes reach ``wanted``.

    ``first`` and ``second`` are a query's squared distances to the two codebooks.
    The heap holds, per started row of the sorted grid, its next pair.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a].tolist(), second[b].tolist()
    sizes = size[a][:, b].tolist()
    a, b = a.tolist(), b.tolist()
    heap, out, met = [(da[0] + db[0], 0, 0)], [], 0
    while heap and met < wanted:
        _, i, j = heapq.heappop(heap)
        if sizes[i][j]:
            out.append((a[i], b[j]))
            met += sizes[i][j]
        if j + 1 < len(db):
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(da):
            heapq.heappush(heap, (da[i + 1] + db[0], i + 1, 0))
    return out


class MultiIndex:
    """Codebooks, the table of indexed rows (id, v, i, j), and the cell sizes."""

    def __init__(self, vectors: DataFrame, centroids: int = 64, sample_rows: int = SAMPLE_ROWS,
                 id_col: str = "vec_id", vector_col: str = "embedding"):
        rows = usable(vectors, id_col, vector_col)
        sample = matrix(hashed_sample(rows, sample_rows).select("v").toArrow()["v"])
        if not len(sample):  # a tiny table may have no row with a small hash
            sample = matrix(rows.limit(sample_rows).select("v").toArrow()["v"])
        self.empty = not len(sample)
        books = self.books = [] if self.empty else [fit_codebook(x, centroids) for x in halves(sample)]

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                i, j = (nearest(x, book) for x, book in zip(halves(matrix(batch.column(1))), books))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32())], names=["id", "v", "i", "j"])

        kind = rows.schema["v"].dataType.simpleString()
        if self.empty:
            self.rows = rows.withColumns({"i": F.lit(0), "j": F.lit(0)})
            return
        self.rows = materialize(rows.mapInArrow(assign, f"id long, v {kind}, i int, j int"))
        # At most centroids squared rows.
        sizes = self.rows.groupBy("i", "j").agg(
            F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("v")).alias("different")
        ).collect()
        self.different = np.zeros((len(books[0]), len(books[1])), dtype=np.int64)
        self.in_row = np.zeros(len(books[0]), dtype=np.int64)
        for r in sizes:
            self.different[r["i"], r["j"]] = r["different"]
            self.in_row[r["i"]] += r["n"]


def search(index: MultiIndex, queries: DataFrame, k: int = 10, share: float = 0.45) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for every (id, v) row of ``queries``.

    ``share``: part of all different vectors whose cells a query walks through. It
    sets the recall; hard data (no structure within clusters) needs a large share.
    """
    if index.empty:
        return queries.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    books, different = index.books, index.different
    # Never fewer than what k neighbours besides the query itself need.
    wanted = max(share * float(different.sum()), 2.0 * (k + 1))
    row_blocks = [max(1, -(-int(n) // ROW_BLOCK)) for n in index.in_row]
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    kind = index.rows.schema["v"].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every query once per (first centroid, row block) it visits, with the second centroids there."""
        for batch in batches:
            x = matrix(batch.column(1))
            distances = [squared(part, book) for part, book in zip(halves(x), books)]
            source, i_out, block, cells = [], [], [], []
            for n in range(len(x)):
                visited: dict[int, list[int]] = {}
                for i, j in walk_cells(distances[0][n], distances[1][n], different, wanted):
                    visited.setdefault(i, []).append(j)
                for i, js in visited.items():
                    for b in range(row_blocks[i]):
                        source.append(n)
                        i_out.append(i)
                        block.append(b)
                        cells.append(js)
            took = batch.take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*took.columns, pa.array(i_out, pa.int32()), pa.array(block, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                names=["id", "v", "i", "row_block", "js"],
            )

    def rerank(rows: pa.Table, asked: pa.Table) -> pa.Table:
        """The k best rows of a block for each of a block of queries, by exact distance."""
        out: list[tuple[int, int, float]] = []
        if len(rows) and len(asked):
            ids, x, j = rows["id"].to_numpy(), matrix(rows["v"]), rows["j"].to_numpy()
            order = np.lexsort((ids, j))
            ids, x, j = ids[order], x[order], j[order]
            known, begin = np.unique(j, return_index=True)
            end = [*begin[1:], len(j)]
            query_ids, q, js = asked["id"].to_numpy(), matrix(asked["v"]), asked["js"].to_pylist()
            near = np.full((len(q), len(x)), np.inf)
            visits: dict[int, list[int]] = {}
            for n, own in enumerate(js):
                for cell in own:
                    visits.setdefault(cell, []).append(n)
            for cell, b, e in zip(known.tolist(), begin, end):
                who = visits.get(cell)
                if who:
                    near[who, b:e] = squared(q[who], x[b:e])
            near[query_ids[:, None] == ids[None]] = np.inf
            slack = 1e-9 * (1 + (x * x).sum(1).max() + (q * q).sum(1).max())
            for n in range(len(q)):
                seen = np.flatnonzero(near[n] < np.inf)
                if len(seen) > k:
                    limit = np.partition(near[n, seen], k - 1)[k - 1] + slack
                    seen = seen[near[n, seen] <= limit]
                exact = np.sqrt(((x[seen] - q[n]) ** 2).sum(1))
                best = np.lexsort((ids[seen], exact))[:k]
                out += [(int(query_ids[n]), int(ids[seen[b]]), float(exact[b])) for b in best]
        query_id, vec_id, score = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(query_id, pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.float64())})

    blocks = F.element_at(F.array(*map(F.lit, row_blocks)), F.col("i") + 1)
    rows = index.rows.withColumn("row_block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    rows = rows.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    routed = queries.select("id", "v").mapInArrow(route, f"id long, v {kind}, i int, row_block int, js array<int>")
    routed = routed.withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    key = ["i", "row_block", "query_block"]
    found = rows.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    window = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

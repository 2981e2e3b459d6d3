"""Approximate nearest neighbours by an inverted multi-index.

The two halves of the vectors are quantised separately: centroids come from ``SAMPLE`` rows (the
first by a hash), every row is filed under its pair of nearest centroids. A query walks the pairs in
order of summed distance with a heap until their cells hold the share ``SCAN`` of all rows, and
never less than ``k`` others. All rows of these cells are ranked by exact distance.

Cells and queries meet in blocks of bounded size: a crowded cell is cut by a hash of the row, queries
likewise. A block returns its best ``k`` per query; they are merged per query.

Vectors that are null, zero, of another width than most of the sample, or hold null or non-finite
components take no part. Ties go to the smaller id. Repeated rows are candidates of their own; a
query skips all rows of its id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mnemospark.llm.staging import stage

SAMPLE = 20_000
CELL_ROWS = 800  # rows that a cell should hold
MOST_CENTROIDS = 1024  # of each half
SCAN = 0.85  # share of the rows that a query ranks; see the README for the recall it gives
BLOCK = 4096  # rows and queries of a block at most, about


def usable(vec: Column) -> Column:
    """Neither null nor zero, all components finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def k_means(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(rows, centers)
        counts = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, rows)
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centers


def squared(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((rows ** 2).sum(1)[:, None] - 2 * rows @ centers.T + (centers ** 2).sum(1), 0)


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return squared(rows, centers).argmin(1)


def walk(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
    """Cells in order of ``left[i] + right[j]`` until they hold ``wanted`` rows (or all)."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen, out, held = [(left[a[0]] + right[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(right) + int(b[j])
        if sizes[cell]:
            out.append(cell)
            held += sizes[cell]
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (left[a[x]] + right[b[y]], x, y))
    return out


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scan: float = SCAN) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest rows of ``vectors`` for each row of ``queries``."""
    pick = lambda df: df.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows, asked = pick(vectors), pick(queries).withColumn("no", F.monotonically_increasing_id())  # ids may be repeated
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    out = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return vectors.sparkSession.createDataFrame([], out)
    widths = np.bincount([len(r["v"]) for r in sample])
    width = int(widths.argmax())
    rows, asked = rows.where(F.size("v") == width), asked.where(F.size("v") == width)
    total = rows.count()
    train, half = np.array([r["v"] for r in sample if len(r["v"]) == width]), max(1, width // 2)
    n_centers = int(max(2, min(MOST_CENTROIDS, (total / CELL_ROWS) ** 0.5)))
    c1 = k_means(train[:, :half], n_centers)
    c2 = k_means(train[:, half:], n_centers) if width > half else np.zeros((1, 0))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"))
            cell = nearest(x[:, :half], c1) * len(c2) + nearest(x[:, half:], c2)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell, pa.int32())], ["id", "v", "cell"])

    index = stage(rows.mapInArrow(file, "id long, v array<double>, cell int"), "multi-index")
    sizes = np.zeros(len(c1) * len(c2), np.int64)
    for r in index.groupBy("cell").count().collect():  # one row per cell, bounded by the centroids
        sizes[r["cell"]] = r["count"]
    wanted = max(scan * total, k + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"))
            cells = [walk(a, b, sizes, wanted) for a, b in zip(squared(x[:, :half], c1), squared(x[:, half:], c2))]
            offsets = pa.array([0, *accumulate(map(len, cells))], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array([c for row in cells for c in row], pa.int32()))], ["id", "v", "no", "cells"])

    n_queries = asked.count()
    query_blocks = max(1, -(-n_queries // BLOCK))
    parts = F.element_at(F.array(*[F.lit(int(max(1, -(-s // BLOCK)))) for s in sizes]), F.col("cell") + 1)
    probes = asked.mapInArrow(probe, "id long, v array<double>, no long, cells array<int>").select(
        "id", "v", "no", F.explode("cells").alias("cell"), F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"))
    probes = probes.select("id", "v", "no", "cell", "qb", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    blocks = index.select("id", "v", "cell", F.pmod(F.xxhash64("id", F.lit(1)), parts).cast("int").alias("part"),
                          F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))

    def rank(qs: pa.Table, vs: pa.Table) -> pa.Table:
        found = {"no": [], "query_id": [], "vec_id": [], "score": []}
        if len(qs) and len(vs):
            x, ids = matrix(vs.column("v").combine_chunks()), vs.column("id").to_numpy()
            for no, q, row in zip(qs.column("no").to_pylist(), qs.column("id").to_pylist(), matrix(qs.column("v").combine_chunks())):
                with np.errstate(over="ignore"):  # a distance beyond the largest number is infinite, and still a distance
                    d = np.sqrt(((x - row) ** 2).sum(1))
                others = np.ones(len(d), bool)
                same = np.flatnonzero(ids == q)  # rows with the query's id and vector are all in this block; one of them is the query
                others[same[(x[same] == row).all(axis=1)][:1]] = False
                near = np.flatnonzero(others)
                if len(near) > k:
                    near = near[d[near] <= np.partition(d[near], k - 1)[k - 1]]
                near = near[np.lexsort((ids[near], d[near]))][:k]
                found["no"] += [no] * len(near)
                found["query_id"] += [q] * len(near)
                found["vec_id"] += ids[near].tolist()
                found["score"] += d[near].tolist()
        return pa.table(found, pa.schema([("no", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    keys = ["cell", "part", "qb"]
    best = probes.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(rank, "no long, query_id long, vec_id long, score double")
    w = Window.partitionBy("no").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Exact and approximate nearest neighbours for a table of query vectors.

The corpus is scanned once. Each task multiplies its Arrow batches with the query block and
keeps a running top-k per query, so a task emits at most ``k`` rows per query and never a row
per (query, vector) pair. Up to ``QUERY_BLOCK`` queries travel to the tasks with the function;
larger query tables are cut into blocks that meet corpus shards by an equi-key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mnemospark.functions.filters import as_predicate
from mnemospark.functions.vectors import METRICS
from mnemospark.operators.ranking import SCORE_DIGITS, top_k
from mnemospark.session import durable

QUERY_BLOCK = 4096      # most query vectors held by one task
SHARD_ROWS = 100_000    # corpus rows per shard when queries come in several blocks
_CELLS = 4_000_000      # most scores held at once in a task


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n and (flat.size % n or len(set(np.diff(column.offsets.to_numpy()))) > 1):
        raise ValueError("vector widths differ")
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _scores(metric: str, q: np.ndarray, m: np.ndarray) -> np.ndarray:
    if q.shape[1] != m.shape[1]:
        raise ValueError(f"vector widths differ: {q.shape[1]} and {m.shape[1]}")
    if metric == "cosine":
        s = (1.0 + np.nan_to_num(_unit(q) @ _unit(m).T, nan=0.0, posinf=0.0, neginf=0.0)) / 2
    elif metric == "dotProduct":
        s = (1.0 + q @ m.T) / 2
    else:
        # Differences, not the expanded product: near-equal long vectors keep their digits.
        s = 1.0 / (1.0 + np.stack([np.linalg.norm(m - one, axis=1) for one in q]))
    # Null-like components (NaN, infinity) score 0 by every metric and cannot push out others.
    return np.round(np.where(np.isfinite(s), s, 0.0), SCORE_DIGITS)


class _TopK:
    """Running best ``k`` corpus rows for a block of queries."""

    def __init__(self, vectors: np.ndarray, k: int, metric: str):
        self.vectors, self.k, self.metric = vectors, k, metric
        self.floor = np.full(len(vectors), -np.inf)
        self.q = np.empty(0, np.int64)
        self.s = np.empty(0, np.float64)
        self.i: np.ndarray | None = None

    def add(self, ids: np.ndarray, m: np.ndarray) -> None:
        step = max(1, _CELLS // max(1, len(m)))
        for lo in range(0, len(self.vectors), step):
            s = _scores(self.metric, self.vectors[lo:lo + step], m)
            floor = self.floor[lo:lo + step]
            if len(m) > self.k:
                kth = np.partition(s, len(m) - self.k, axis=1)[:, len(m) - self.k]
                floor = np.maximum(floor, kth)
            rows, cols = np.nonzero(s >= floor[:, None])  # ties at the floor stay in
            self._merge(rows + lo, s[rows, cols], ids[cols])

    def _merge(self, q: np.ndarray, s: np.ndarray, i: np.ndarray) -> None:
        if self.i is not None:
            q, s, i = np.concatenate([self.q, q]), np.concatenate([self.s, s]), np.concatenate([self.i, i])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - first < self.k
        self.q, self.s, self.i = q[keep], s[keep], i[keep]
        counts = np.bincount(self.q, minlength=len(self.vectors))
        full = np.nonzero(counts >= self.k)[0]
        ends = np.cumsum(counts)
        self.floor[full] = self.s[ends[full] - 1]


def _column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _groups(table: pa.Table | pa.RecordBatch, within: Sequence[str]) -> Iterator[tuple[Any, np.ndarray | slice]]:
    """Row numbers per key; one group of everything when every query meets every row."""
    if not within:
        yield None, slice(0, table.num_rows)
        return
    coded = [_column(table, c).dictionary_encode() for c in within]
    values = [c.dictionary.to_pylist() for c in coded]
    codes = np.zeros(table.num_rows, dtype=np.int64)
    for c, known in zip(coded, values):
        codes = codes * len(known) + c.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    keys, first = np.unique(codes[order], return_index=True)
    for key, rows in zip(keys.tolist(), np.split(order, first[1:])):
        parts = []
        for known in reversed(values):
            key, at = divmod(key, len(known))
            parts.append(known[at])
        yield tuple(reversed(parts)), rows


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
    return np.array(values.tolist()) if values.dtype == object else values


def _emit(found: dict[Any, tuple[np.ndarray, _TopK]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for query_ids, top in found.values():
        if top.i is not None and len(top.q):
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[top.q].tolist(), schema.field(0).type),
                 pa.array(top.i.tolist(), schema.field(1).type),
                 pa.array(top.s, pa.float64())], schema=schema)


def _query_blocks(q: pa.Table, within: Sequence[str]) -> dict[Any, tuple[np.ndarray, np.ndarray]]:
    """Query ids and vectors per key."""
    if not q.num_rows:
        return {}
    vectors, ids = _matrix(q.column("_v")), _ids(q.column("query_id"))
    return {key: (ids[rows], vectors[rows]) for key, rows in _groups(q, within)}


def _scan(queries: dict, within: Sequence[str], k: int, metric: str, schema: pa.Schema):
    """Task body: one pass over the corpus batches of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {key: (ids, _TopK(vectors, k, metric)) for key, (ids, vectors) in queries.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, m = _ids(batch.column("id")), None
            for key, rows in _groups(batch, within):
                if key in found:
                    m = _matrix(batch.column("_v")) if m is None else m
                    found[key][1].add(ids[rows], m[rows])
        yield from _emit(found, schema)
    return run


def _block_scan(within: Sequence[str], k: int, metric: str, schema: pa.Schema):
    """Cogroup body: one query block against one corpus shard."""
    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return schema.empty_table()
        body = _scan(_query_blocks(q, within), within, k, metric, schema)
        return pa.Table.from_batches(list(body(iter(c.combine_chunks().to_batches()))), schema=schema)
    return run


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StringType):
        return pa.string()
    if isinstance(kind, T.IntegerType):
        return pa.int32()
    if isinstance(kind, T.LongType):
        return pa.int64()
    raise TypeError(f"ids must be strings or integers, not {kind.simpleString()}")


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int = 4, *, metric: str = "cosine",
                pre_filter: Column | Mapping[str, Any] | None = None,
                post_filter: Callable[[DataFrame], DataFrame] | None = None,
                query_id: str = "query_id", query_vector: str = "vector",
                id_col: str = "id", vector_col: str = "embedding",
                within: Sequence[str] = (), query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, id, rank, score)`` of the ``k`` nearest corpus rows of each query.

    ``pre_filter`` narrows the corpus before anything is compared. ``within`` names columns
    present on both sides; a query meets only rows that agree on all of them.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if k < 1:
        raise ValueError("k must be positive")
    predicate = as_predicate(pre_filter)
    if predicate is not None:
        corpus = corpus.filter(predicate)
    keys = list(within)
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("_v"), *keys).dropna()
    c = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("_v"), *keys).dropna()
    out = T.StructType([T.StructField("query_id", q.schema["query_id"].dataType),
                        T.StructField("id", c.schema["id"].dataType),
                        T.StructField("score", T.DoubleType())])
    schema = pa.schema([("query_id", _arrow_type(out["query_id"].dataType)),
                        ("id", _arrow_type(out["id"].dataType)), ("score", pa.float64())])

    head = q.limit(query_block + 1).toArrow()  # at most one block and one row reach the driver
    if head.num_rows <= query_block:
        body = _scan(_query_blocks(head, keys), keys, k, metric, schema)
        partial = c.mapInArrow(body, out)
    else:
        # More queries than one task may hold: blocks x shards, joined on their numbers.
        q = durable(q)
        n_blocks = -(-q.count() * 5 // (query_block * 4))
        n_shards = max(1, -(-c.count() // SHARD_ROWS))
        blocks = (q.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)))
                  .withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))))
        shards = (c.withColumn("_shard", F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int"))
                  .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint")))))
        partial = (blocks.groupBy("_block", "_shard").cogroup(shards.groupBy("_block", "_shard"))
                   .applyInArrow(_block_scan(keys, k, metric, schema), out))
    hits = top_k(partial, k).select("query_id", "id", "rank", "score")
    return hits if post_filter is None else hits.transform(post_filter)


def filtered_vector_search(structured: Sequence[Mapping[str, Any]], vectors: DataFrame,
                           corpus: DataFrame, *, default_k: int = 4, **options: Any) -> DataFrame:
    """Self-query search: every query brings its own structured filter and limit.

    ``structured`` holds ``{"query_id", "filter", "limit"}``; ``vectors`` holds their embeddings.
    Queries with the same filter share one pass: a corpus row enters the scan once per filter it
    satisfies, and not at all when it satisfies none.
    """
    spark = corpus.sparkSession
    numbered: dict[str, int] = {}
    predicates: list[Column] = []
    rows = []
    for s in structured:
        spec = s.get("filter") or {}
        number = numbered.setdefault(repr(spec), len(predicates))
        if number == len(predicates):
            predicates.append(as_predicate(spec))
        rows.append((s["query_id"], number, s.get("limit") or default_k))
    id_type = vectors.schema[options.get("query_id", "query_id")].dataType.simpleString()
    plan = spark.createDataFrame(rows, f"query_id {id_type}, _filter int, _k int")
    passing = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in enumerate(predicates)]))
    tagged = corpus.withColumn("_filter", F.explode(passing))
    widest = max(r[2] for r in rows)
    hits = vector_topk(vectors.join(F.broadcast(plan), "query_id"), tagged, widest, within=["_filter"], **options)
    return hits.join(F.broadcast(plan.select("query_id", "_k")), "query_id").filter("rank <= _k").drop("_k")


def above_threshold(hits: DataFrame, threshold: float | None) -> DataFrame:
    """Keep hits scoring at least ``threshold``; ``None`` keeps all."""
    return hits if threshold is None else hits.filter(F.col("score") >= threshold)


# ---- approximate search -------------------------------------------------------------------

def build_cells(corpus: DataFrame, n_cells: int, *, id_col: str = "id",
                vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assign every vector to its nearest pivot; pivots are the rows with the smallest id hash.

    Returns the corpus with a ``cell`` column and the pivots. Write the table partitioned by
    ``cell`` so that a probe reads only its cells. ``n_cells`` bounds what the tasks carry.
    """
    if not 1 <= n_cells <= QUERY_BLOCK:
        raise ValueError(f"n_cells must lie in 1..{QUERY_BLOCK}")
    usable = corpus.filter(F.col(vector_col).isNotNull())
    picked = (usable.orderBy(F.xxhash64(id_col), id_col).limit(n_cells)
              .select(F.col(vector_col).alias("_v")).toArrow())
    pivots = _unit(_matrix(picked.column("_v")))

    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield pa.array(np.argmax(_unit(_matrix(vectors)) @ pivots.T, axis=1).astype(np.int32))

    from pyspark.sql.functions import arrow_udf
    assign = arrow_udf(_typed_iterator(nearest), "int")
    return usable.withColumn("cell", assign(F.col(vector_col))), pivots


def _typed_iterator(fn):
    fn.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return fn


def ann_topk(queries: DataFrame, cells: DataFrame, pivots: np.ndarray, k: int = 4,
             oversampling: int = 10, *, query_id: str = "query_id", query_vector: str = "vector",
             id_col: str = "id", vector_col: str = "embedding", metric: str = "cosine",
             pre_filter: Column | Mapping[str, Any] | None = None) -> DataFrame:
    """Approximate top-k: probe nearest cells until they hold ``k * oversampling`` vectors, re-score exactly.

    The probed cells are searched like ``vector_topk`` with ``within=['cell']``, so a hot cell is
    split over tasks as any other scan and nothing is shuffled but the hits.
    """
    predicate = as_predicate(pre_filter)
    if predicate is not None:
        cells = cells.filter(predicate)
    sizes = np.zeros(len(pivots), np.int64)
    for row in cells.groupBy("cell").count().toLocalIterator():  # at most one row per pivot
        sizes[row["cell"]] = row["count"]
    wanted = k * oversampling

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            order = np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            rows, nth = np.nonzero((before < wanted) & (sizes[order] > 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(pa.array(rows)), batch.column("vector").take(pa.array(rows)),
                 pa.array(order[rows, nth].astype(np.int32))], names=["query_id", "vector", "cell"])

    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("vector"))
    probes = q.mapInArrow(probe, T.StructType([*q.schema.fields, T.StructField("cell", T.IntegerType())]))
    # At most one row per pivot; on a table partitioned by cell, only the probed folders are read.
    probed = [r["cell"] for r in probes.select("cell").distinct().toLocalIterator()]
    cells = cells.filter(F.col("cell").isin(probed))
    return vector_topk(probes, cells, k, metric=metric, id_col=id_col, vector_col=vector_col,
                       within=["cell"])

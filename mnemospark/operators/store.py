"""Namespaced key-value items with TTL, search and namespace listing.

Items: ``namespace ARRAY<STRING>, ns_str, key, value, created_at, updated_at`` and optionally
``embedding``. ``value`` is a VARIANT or JSON text. The key is ``(ns_str, key)``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mnemospark.functions.filters import value_equals
from mnemospark.functions.paths import parents
from mnemospark.operators.embedding import hashed_embedding
from mnemospark.operators.hybrid import rerank, term_overlap
from mnemospark.operators.tables import delete_keys, last_per_key, narrowed, upsert
from mnemospark.operators.vector_search import vector_topk
from mnemospark.session import few

KEY = ["ns_str", "key"]


def namespace_ok(ns: Column | str, sep: str = "/") -> Column:
    """No empty part and no separator inside a part."""
    c = F.col(ns) if isinstance(ns, str) else ns
    return F.forall(c, lambda x: (x != "") & ~x.contains(sep))


def check_namespaces(df: DataFrame, sep: str = "/") -> DataFrame:
    """Pass rows through, failing on the first invalid namespace."""
    return df.withColumn("namespace", F.when(namespace_ok("namespace", sep), F.col("namespace")).otherwise(
        F.raise_error(F.concat(F.lit("invalid namespace: "), F.to_json("namespace"))).cast("array<string>")))


def with_namespace_keys(df: DataFrame, sep: str = "/") -> DataFrame:
    """Add ``ns_str`` and the path parents used as search pre-filter."""
    return (df.withColumn("ns_str", F.array_join("namespace", sep))
            .withColumn("namespace_prefix", parents("namespace", sep)))


def backfill_namespace(items: DataFrame, sep: str = "/") -> DataFrame:
    """Fill a missing ``ns_str`` from the array; invalid parts fail the job."""
    filled = F.when(namespace_ok("namespace", sep), F.array_join("namespace", sep)).otherwise(
        F.raise_error(F.concat(F.lit("invalid namespace: "), F.to_json("namespace"))).cast("string"))
    return items.withColumn("ns_str", F.coalesce("ns_str", filled))


def store_get(items: DataFrame, keys: DataFrame) -> DataFrame:
    """Items of the asked ``(ns_str, key)`` rows."""
    return items.join(keys.select(*KEY), KEY, "left_semi")


def refresh(items: DataFrame, keys: DataFrame, now: Column) -> DataFrame:
    """Items after a reading that refreshes ``updated_at`` of the asked keys."""
    touched = keys.select(*KEY).distinct().withColumn("updated_at", now)
    return upsert(items, touched.join(items.select(*KEY), KEY, "left_semi"), KEY, ["updated_at"])


def store_apply(items: DataFrame, ops: DataFrame, sep: str = "/") -> tuple[DataFrame, DataFrame]:
    """Apply a batch of operations; returns ``(new items, results of the gets)``.

    ``ops(seq, op, namespace, key, value, at)`` with op ``put``, ``get`` or ``delete``; a put of a
    null value deletes. Gets see the items before the batch. The last write per key wins; a put
    keeps ``created_at`` of an existing item.
    """
    keyed = check_namespaces(ops, sep).withColumn("ns_str", F.array_join("namespace", sep))
    gets = keyed.filter(F.col("op") == "get").select("seq", *KEY)
    reads = gets.join(narrowed(items, gets, KEY).withColumn("_found", F.lit(True)), KEY, "left").withColumn(
        "found", F.coalesce("_found", F.lit(False))).drop("_found")
    writes = last_per_key(keyed.filter(F.col("op").isin("put", "delete")).select(
        *KEY, "seq", "op", "namespace", "value", "at"), KEY, "seq")
    gone = (F.col("op") == "delete") | F.col("value").isNull()
    puts = writes.filter(~gone).select(*KEY, "namespace", "value", F.col("at").alias("updated_at"),
                                       F.col("at").alias("created_at"))
    after = upsert(delete_keys(items, writes.filter(gone), KEY), puts, KEY,
                   ["value", "updated_at"], ["namespace", "created_at"])
    return after, reads


def _as_variant(items: DataFrame, col: str = "value") -> Column:
    return F.parse_json(F.col(col)) if isinstance(items.schema[col].dataType, T.StringType) else F.col(col)


def _path_at(ns: str, start: Column, path: Sequence[str]) -> Column:
    """The parts of ``ns`` from ``start`` on equal the path, part by part; ``*`` equals any."""
    wanted = F.array(*[F.lit(None if p == "*" else p) for p in path]).cast("array<string>")
    cut = F.slice(ns, F.greatest(start, F.lit(0)) + 1, len(path))
    return (F.size(ns) >= len(path)) & F.forall(F.zip_with(cut, wanted, lambda have, want: want.isNull() | (have == want)), lambda same: same)


def match_prefix(prefix: Sequence[str], ns: str = "namespace") -> Column:
    """Namespace starts with the path; ``*`` stands for any one part."""
    return _path_at(ns, F.lit(0), prefix)


def match_suffix(suffix: Sequence[str], ns: str = "namespace") -> Column:
    """Namespace ends with the path; ``*`` stands for any one part."""
    return _path_at(ns, F.size(ns) - len(suffix), suffix)


def store_search(items: DataFrame, prefix: Sequence[str] = (), *,
                 filter: Mapping[str, Any] | None = None, limit: int | None = None, offset: int = 0,
                 queries: DataFrame | None = None, metric: str = "cosine",
                 rerank_field: str | None = None, num_docs_to_rerank: int | None = None,
                 oversampling_factor: int = 10,
                 scorer: Callable[[Column, Column], Column] = term_overlap) -> DataFrame:
    """Items below a namespace that satisfy an equality filter.

    Without queries: items in key order. With ``queries(query_id, vector[, text])``: nearest items
    per query, namespace and filter applied first, optionally reranked on a field of the value.
    """
    kept = items.filter(match_prefix(prefix)) if prefix else items
    if filter:
        kept = kept.filter(value_equals(_as_variant(items), filter))
    if queries is None:
        ordered = kept.orderBy(*KEY)
        ordered = ordered.offset(offset) if offset else ordered
        return ordered if limit is None else ordered.limit(limit)
    if limit is None:
        raise ValueError("a vector search needs a limit")
    reach = limit + offset
    pool = num_docs_to_rerank or reach * oversampling_factor
    named = kept.withColumn("id", F.to_json(F.struct(*KEY)))
    hits = vector_topk(queries, named, pool if rerank_field is not None else reach, metric=metric)
    if rerank_field is not None:
        bodies = named.select("id", F.try_variant_get(_as_variant(items), f"$.{rerank_field}", "string").alias("text"))
        hits = rerank(hits, queries, bodies, scorer, k=reach)
    hits = hits.filter(F.col("rank") > offset) if offset else hits
    key = F.from_json("id", "ns_str string, key string")
    placed = few(hits.select("query_id", "rank", "score", key["ns_str"].alias("ns_str"), key["key"].alias("key")))
    return placed.join(kept.drop("embedding"), KEY)


def list_namespaces(items: DataFrame, *, prefix: Sequence[str] | None = None,
                    suffix: Sequence[str] | None = None, max_depth: int | None = None,
                    limit: int | None = None, offset: int = 0) -> DataFrame:
    """Distinct namespaces that match, cut to ``max_depth``; deduplicated before the limit."""
    kept = items
    if prefix:
        kept = kept.filter(match_prefix(prefix))
    if suffix:
        kept = kept.filter(match_suffix(suffix))
    ns = F.col("namespace") if not max_depth else F.slice("namespace", 1, max_depth)
    out = kept.select(ns.alias("namespace")).distinct().orderBy("namespace")
    out = out.offset(offset) if offset else out
    return out if limit is None else out.limit(limit)


def index_text(items: DataFrame, field: str, dims: int = 64, *, indexed: Column | None = None) -> DataFrame:
    """Text at the dotted ``field`` of each value and its vector; null where indexing is off or the text missing."""
    if "*" in field:
        raise ValueError("only one field can be indexed")
    path = "$" if field == "$" else "$." + field
    value = _as_variant(items)
    text = F.try_variant_get(value, path, "string") if field != "$" else F.to_json(value)
    if indexed is not None:
        text = F.when(indexed, text)
    return items.withColumn("index_text", text).withColumn(
        "embedding", F.when(F.col("index_text").isNotNull(), hashed_embedding("index_text", dims)))

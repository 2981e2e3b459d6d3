"""Chat history, caches, document store and index ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mnemospark.functions.values import encode_list
from mnemospark.operators.tables import delete_keys, insert_new, lookup_in_order, narrowed, upsert
from mnemospark.operators.vector_search import above_threshold, vector_topk
from mnemospark.session import few

# ---- chat history: session_id, seq, message ------------------------------------------------


def add_messages(history: DataFrame, new: DataFrame) -> DataFrame:
    return history.unionByName(new)


def messages(history: DataFrame, history_size: int | None = None) -> DataFrame:
    """Messages, each session in order; ``history_size`` keeps the last N of every session.

    The limit is taken per partition before the shuffle, so a very long session does not move. Sessions stand
    whole and in order inside a partition; sort the result for an order over all of them.
    """
    if history_size is None:
        return history.repartition("session_id").sortWithinPartitions("session_id", "seq")
    if history_size <= 0:
        return history.limit(0)
    newest = W.partitionBy("session_id").orderBy(F.desc("seq"))
    return (history.withColumn("_n", F.row_number().over(newest))
            .filter(F.col("_n") <= history_size).drop("_n").sortWithinPartitions("session_id", "seq"))


def clear_sessions(history: DataFrame, sessions: DataFrame) -> DataFrame:
    return delete_keys(history, sessions, ["session_id"])


# ---- exact cache: prompt, llm, return_val --------------------------------------------------


def cache_update(cache: DataFrame, new: DataFrame, *, seq: str | None = None) -> DataFrame:
    """Cache after storing generations ``(prompt, llm, generations ARRAY<STRING>)``."""
    ready = new.withColumn("return_val", encode_list("generations")).drop("generations")
    return upsert(cache, ready, ["prompt", "llm"], ["return_val"], seq=seq)


def cache_lookup(cache: DataFrame, asked: DataFrame) -> DataFrame:
    """Asked prompts with their cached value; a miss has a null ``return_val``."""
    key = ["prompt", "llm"]
    return asked.join(narrowed(cache, asked, key).select(*key, "return_val"), key, "left")


def cache_clear(cache: DataFrame, **equals: str) -> DataFrame:
    """Rows that stay; no condition clears everything. Unknown fields are an error."""
    if not equals:
        return cache.limit(0)
    unknown = set(equals) - set(cache.columns)
    if unknown:
        raise ValueError(f"the cache has no field {sorted(unknown)}")
    hit = F.lit(True)
    for name, value in equals.items():
        hit = hit & F.coalesce(F.col(name) == value, F.lit(False))
    return cache.filter(~hit)


# ---- semantic cache: id, embedding, llm_string, return_val ---------------------------------


def semantic_cache_lookup(queries: DataFrame, cache: DataFrame, threshold: float | None = None, *,
                          metric: str = "cosine") -> DataFrame:
    """Nearest cached row with the same ``llm_string``, if it scores at least ``threshold``."""
    nearest = vector_topk(queries, cache, 1, metric=metric, within=["llm_string"])
    hits = above_threshold(nearest, threshold).select("query_id", "id", "score")
    return few(hits).join(cache.select("id", "return_val"), "id")


# ---- document store: key, page_content, metadata -------------------------------------------


def mget(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``(pos, key, ..., found)`` in asked order."""
    return lookup_in_order(asked, docs, "key")


def mset(docs: DataFrame, new: DataFrame, *, seq: str | None = None) -> DataFrame:
    """Insert; a key that is already present keeps its row."""
    return insert_new(docs, new, ["key"], seq=seq)


def mdelete(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return delete_keys(docs, keys, ["key"])


def yield_keys(docs: DataFrame, prefix: str | None = None) -> DataFrame:
    keys = docs.select("key")
    return keys.filter(F.col("key").startswith(prefix)) if prefix else keys


# ---- index ledger: namespace, key, group_id, updated_at (epoch seconds) --------------------


def ledger_update(ledger: DataFrame, namespace: str, keys: DataFrame, now: float | Column, *,
                  time_at_least: float | None = None, seq: str | None = None) -> DataFrame:
    """Record ``keys(key[, group_id][, seq])`` as indexed now; a clock behind ``time_at_least`` is an error.

    Of a repeated key the pair with the highest ``seq`` counts; without one, the largest group.
    """
    if time_at_least is not None and isinstance(now, (int, float)) and now < time_at_least:
        raise ValueError("the clock is behind the given time")
    at = now if isinstance(now, Column) else F.lit(float(now))
    group = F.col("group_id") if "group_id" in keys.columns else F.lit(None).cast("string")
    last = F.max(F.struct(F.col(seq).alias("seq") if seq else F.lit(0).alias("seq"), group.alias("group_id")))
    rows = keys.groupBy("key").agg(last["group_id"].alias("group_id")) \
        .select(F.lit(namespace).alias("namespace"), "key", "group_id", at.alias("updated_at"))
    return upsert(ledger, rows, ["namespace", "key"], ["group_id", "updated_at"])


def ledger_exists(ledger: DataFrame, namespace: str, asked: DataFrame) -> DataFrame:
    """``(pos, key, found)`` for each asked key."""
    mine = ledger.filter(F.col("namespace") == namespace).select("key")
    return lookup_in_order(asked, mine, "key")


def ledger_list_keys(ledger: DataFrame, namespace: str, *, before: float | None = None,
                     after: float | None = None, group_ids: Sequence[str] | None = None,
                     limit: int | None = None) -> DataFrame:
    """Keys of a namespace; all given conditions must hold, bounds are strict."""
    kept = ledger.filter(F.col("namespace") == namespace)
    if before is not None:
        kept = kept.filter(F.col("updated_at") < before)
    if after is not None:
        kept = kept.filter(F.col("updated_at") > after)
    if group_ids is not None:
        kept = kept.filter(F.col("group_id").isin(*group_ids))
    keys = kept.select("key")
    return keys if limit is None else keys.orderBy("key").limit(limit)


def ledger_delete(ledger: DataFrame, namespace: str, keys: DataFrame) -> DataFrame:
    return delete_keys(ledger, keys.select("key", F.lit(namespace).alias("namespace")), ["namespace", "key"])

"""Maximal marginal relevance: nearest candidates, then greedy diversity per query."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mnemospark.operators.vector_search import vector_topk
from mnemospark.session import few


def _unit_rows(values: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in values])
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.nan_to_num(np.divide(m, length, out=np.zeros_like(m), where=length > 0))


def _pick(relevance: np.ndarray, alike: np.ndarray, k: int, balance: float) -> list[int]:
    """Greedy order; ``argmax`` keeps the earliest candidate on ties."""
    chosen: list[int] = []
    closest = np.full(len(relevance), -np.inf)
    open_ = np.ones(len(relevance), dtype=bool)
    for _ in range(min(k, len(relevance))):
        value = relevance if not chosen else balance * relevance - (1 - balance) * closest
        best = int(np.argmax(np.where(open_, value, -np.inf)))
        chosen.append(best)
        open_[best] = False
        closest = np.maximum(closest, alike[best])
    return chosen


def mmr(queries: DataFrame, corpus: DataFrame, k: int = 4, fetch_k: int = 20,
        lambda_mult: float = 0.5, *, id_col: str = "id", vector_col: str = "embedding",
        query_vector: str = "vector", metric: str = "cosine",
        pre_filter: Column | Mapping[str, Any] | None = None) -> DataFrame:
    """``(query_id, id, rank, score)``; each group holds at most ``fetch_k`` candidates."""
    fetched = vector_topk(queries, corpus, fetch_k, metric=metric, pre_filter=pre_filter,
                          id_col=id_col, vector_col=vector_col, query_vector=query_vector)
    vectors = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("_v"))
    asked = queries.select("query_id", F.col(query_vector).alias("_q"))
    candidates = few(fetched).join(vectors, "id").join(asked, "query_id")
    out = T.StructType([fetched.schema["query_id"], fetched.schema["id"],
                        T.StructField("rank", T.IntegerType()), T.StructField("score", T.DoubleType())])

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank", kind="stable").reset_index(drop=True)
        units = _unit_rows(group["_v"])
        order = _pick(units @ _unit_rows(group["_q"].iloc[:1])[0], units @ units.T, k, lambda_mult)
        picked = group.iloc[order][["query_id", "id", "score"]].copy()
        picked.insert(2, "rank", np.arange(1, len(order) + 1, dtype=np.int32))
        return picked

    return candidates.groupBy("query_id").applyInPandas(choose, out)

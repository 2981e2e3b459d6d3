"""Parent-document retrieval over a chunk table."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.functions.filters import as_predicate
from mnemospark.operators.chunking import chunk_chars
from mnemospark.operators.ranking import top_k
from mnemospark.session import few


def split_children(parents: DataFrame, chunk_size: int = 400, overlap: int = 0, *,
                   id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Children ``(id, doc_id, chunk_index, text)``; ``doc_id`` points at the parent."""
    pieces = chunk_chars(parents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")),
                         size=chunk_size, overlap=overlap, text_col="_t")
    return pieces.select(F.concat_ws("#", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias("id"),
                         "doc_id", "chunk_index", F.col("content").alias("text"))


def parent_documents(hits: DataFrame, chunks: DataFrame, parents: DataFrame, *, k: int | None = None,
                     parent_id: str = "id",
                     parent_filter: Column | Mapping[str, Any] | None = None) -> DataFrame:
    """Distinct parents of child hits, ordered by their best child.

    ``hits(query_id, id, score)``, ``chunks(id, doc_id)``. Partial maxima are taken before the
    shuffle, so a parent with very many hit children is no hot group.
    """
    predicate = as_predicate(parent_filter)
    if predicate is not None:
        parents = parents.filter(predicate)
    best = (few(hits).join(chunks.select("id", "doc_id"), "id")
            .groupBy("query_id", "doc_id").agg(F.max("score").alias("score")))
    found = few(best.withColumnRenamed("doc_id", "id")).join(
        parents.withColumnRenamed(parent_id, "id"), "id")
    return top_k(found, k)

"""``ls``, ``glob`` and ``grep`` over a chunk table, and ETag comparison of listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.functions.paths import (basename, first_segment, folder_prefix, matches_glob, relative, under)
from mnemospark.functions.text import contains_ignore_case
from mnemospark.operators.hybrid import fused_scores
from mnemospark.operators.ranking import SCORE_DIGITS, first_per_key, top_k
from mnemospark.operators.text_search import TextIndex, bm25_topk, first_in_scope
from mnemospark.operators.vector_search import vector_topk
from mnemospark.session import durable, few

DEPTHS = (16, 128)  # text hits per line asked for that are ranked first; queries that need more are searched whole
TEXT_WEIGHT, PENALTY = 0.5, 60  # of the fusion of both legs


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    return ordered if limit is None else ordered.limit(limit)


def diff_listing(listing: DataFrame, stored: DataFrame) -> DataFrame:
    """``(path, etag, stored_etag, change)`` with created, updated, deleted or unchanged.

    ``stored`` may hold one row per chunk; it is reduced to one ETag per file before the join.
    """
    per_file = stored.groupBy("path").agg(F.min("etag").alias("stored_etag"))
    both = listing.select("path", "etag", F.lit(True).alias("_now")).join(per_file, "path", "full_outer")
    change = (F.when(F.col("_now").isNull(), "deleted")
              .when(F.col("stored_etag").isNull(), "created")
              .when(F.col("etag") != F.col("stored_etag"), "updated").otherwise("unchanged"))
    return both.select("path", "etag", "stored_etag", change.alias("change"))


def ls(chunks: DataFrame, path: str = "", *, limit: int | None = None, path_col: str = "source_path") -> DataFrame:
    """Immediate children ``(path, is_dir)`` in order; folders end with ``/``."""
    prefix = folder_prefix(path)
    rest = relative(path_col, prefix)
    children = _first(chunks.filter(under(path_col, prefix))
                      .select(first_segment(rest).alias("segment"), rest.contains("/").alias("deeper"))
                      .filter("segment <> ''")
                      .groupBy("segment").agg(F.max("deeper").alias("is_dir"))
                      .orderBy("segment"), limit)
    return children.select(F.concat(F.lit(prefix), F.col("segment"),
                                    F.when(F.col("is_dir"), "/").otherwise("")).alias("path"), "is_dir")


def glob(chunks: DataFrame, pattern: str, path: str = "", *, limit: int | None = None,
         path_col: str = "source_path") -> DataFrame:
    """Distinct paths below ``path`` whose relative part matches, in order."""
    prefix = folder_prefix(path)
    return _first(chunks.filter(under(path_col, prefix) & (F.col(path_col) != "")
                                & matches_glob(relative(path_col, prefix), pattern))
                  .select(F.col(path_col).alias("path")).distinct().orderBy("path"), limit)


def _in_scope(path: str, glob_pattern: str) -> Column:
    scope = F.lit(True)
    if path.rstrip("/"):
        scope = under("source_path", folder_prefix(path)) | (F.col("source_path") == path.rstrip("/"))
    if glob_pattern:
        scope = scope & matches_glob(basename("source_path"), glob_pattern, dotfiles=True)
    return scope


def dedupe_matches(hits: DataFrame, order: list[Column], keys: tuple[str, ...] = ("source_path", "line_start")) -> DataFrame:
    """First hit per path and line."""
    return first_per_key(hits, list(keys), order)


def grep_literal(chunks: DataFrame, pattern: str, path: str = "", glob_pattern: str = "", *,
                 limit: int | None = None) -> DataFrame:
    """Chunks holding the literal, ignoring case: ``(source_path, line_start, content)``."""
    return matches_in_scope(chunks, contains_ignore_case("content", pattern), path, glob_pattern, limit=limit)


def matches_in_scope(chunks: DataFrame, test: Column, path: str = "", glob_pattern: str = "", *,
                     limit: int | None = None) -> DataFrame:
    """Chunks below ``path`` that pass a test, the first of each path and line, in order."""
    found = chunks.filter(_in_scope(path, glob_pattern) & test)
    once = dedupe_matches(found.select("source_path", "line_start", "chunk_index", "content"),
                          [F.asc("chunk_index")])
    return _first(once.orderBy("source_path", "line_start"), limit).select("source_path", "line_start", "content")


def grep_hybrid(queries: DataFrame, chunks: DataFrame, path: str = "", glob_pattern: str = "", *,
                index: TextIndex | None = None, limit: int) -> DataFrame:
    """Text and vector legs fused with equal weights, deduplicated per line, then the first ``limit`` per query.

    ``chunks(id, source_path, line_start, content, embedding)``. Both legs rank the chunks in scope
    only; the vector leg gives the nearest ``2 * limit``.
    Without a ``vector`` column in ``queries`` only the text leg runs.
    """
    scope = _in_scope(path, glob_pattern)
    narrowed = bool(path or glob_pattern)
    keep = chunks.filter(scope).select("id") if narrowed else None
    near = None
    if "vector" in queries.columns:
        near = few(vector_topk(queries, chunks, 2 * limit, pre_filter=scope if narrowed else None))

    def best(text_leg: DataFrame, asked: DataFrame) -> DataFrame:
        """The first lines of some of the queries."""
        legs, weights = {"fulltext": text_leg}, {"fulltext": TEXT_WEIGHT}
        if near is not None:
            legs["vector"], weights["vector"] = _of(near, asked, "left_semi"), 1 - TEXT_WEIGHT
        fused = few(fused_scores(legs, weights).select("query_id", "id", "score"))
        placed = fused.join(chunks.select("id", "source_path", "line_start", "content"), "id")
        once = dedupe_matches(placed, [F.desc("score"), F.asc("id")], ("query_id", "source_path", "line_start"))
        return top_k(once, limit).select("query_id", "rank", "source_path", "line_start", "content", "score")

    done, left = [], queries  # queries whose lines are not certain yet
    for depth in [n * max(1, limit) for n in DEPTHS] if index is None else []:
        leg = first_in_scope(left, chunks, depth, scope, near, fields=["content"])
        if leg is None:  # too many query terms
            break
        leg = durable(leg)
        found = durable(best(leg, left.select("query_id")))
        # A text hit that was not seen stands behind place ``depth``: none can matter where the last line has a higher score.
        unseen = TEXT_WEIGHT / (depth + 1 + PENALTY) + 10.0 ** -SCORE_DIGITS
        certain = found.filter((F.col("rank") == limit) & (F.col("score") > unseen))
        uncertain = few(_of(leg.filter(F.col("rank") == depth).select("query_id").distinct(), certain, "left_anti"))
        done.append(_of(found, uncertain, "left_anti"))
        if uncertain.isEmpty():
            return reduce(DataFrame.unionByName, done)
        left = _of(left, uncertain, "left_semi")
    rest = bm25_topk(left, chunks.select("id", "content") if index is None else index, None, fields=["content"], keep_ids=keep)
    return reduce(DataFrame.unionByName, [*done, best(rest, left.select("query_id"))])


def _of(rows: DataFrame, queries: DataFrame, how: str) -> DataFrame:
    """Rows whose query is among others, or is not; a null id is one like any other."""
    names = queries.select(F.col("query_id").alias("_of")).distinct()
    return rows.join(names, F.col("query_id").eqNullSafe(F.col("_of")), how)

"""Overlapping windows over tokens or characters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mnemospark.functions.text import newline_count, pieces

TOKEN_LIMIT = 512
TOKEN_OVERLAP = 64
PAGE_BLOCK = 1024


def _check(limit: int, overlap: int) -> int:
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the window")
    return limit - overlap


def _window_count(n: Column, limit: int, step: int) -> Column:
    """Windows until one reaches the end: none for nothing, else one plus the steps past the first."""
    return (F.when(n <= 0, 0).when(n <= limit, 1)
            .otherwise(F.ceil((n - limit) / F.lit(step)) + 1).cast("int"))


def chunk_tokens(df: DataFrame, limit: int = TOKEN_LIMIT, overlap: int = TOKEN_OVERLAP, *,
                 key: str = "source_path", text_col: str = "text", page_col: str | None = None,
                 tokenizer: Callable[[str], list[str]] | None = None,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """Token windows with ``chunk_index, page_number, char_start, char_end, line_start, content``.

    The default tokenizer is whitespace-led words, split in the JVM. Another tokenizer is a
    function from text to the pieces it consists of (a byte-pair encoding's decoded tokens).
    Texts are split where they lie; only multi-page sources need a shuffle, to number chunks
    across pages.
    """
    step = _check(limit, overlap)
    if tokenizer is None:
        toks = pieces(text_col)
    else:
        @F.pandas_udf("array<string>")
        def split(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for series in texts:
                yield series.map(lambda t: tokenizer(t) if t else [])
        toks = split(F.col(text_col))
    page = F.lit(None).cast("int") if page_col is None else F.col(page_col)
    base = df.select(F.col(key), *carry, page.alias("page_number"), toks.alias("_toks"))
    count = _window_count(F.size("_toks"), limit, step)
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    # One pass per text: the step-long blocks give every window's start, the slices its content.
    cut = base.select(
        key, *carry, "page_number",
        F.transform(numbers, lambda w: F.struct(
            F.array_join(F.slice("_toks", w * step + 1, F.lit(step)), "").alias("block"),
            F.array_join(F.slice("_toks", w * step + 1, F.lit(limit)), "").alias("content"))).alias("_cut"))
    starts = F.aggregate(
        "_cut",
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("line"),
                 F.array().cast("array<struct<at:int,line:int>>").alias("seen")),
        lambda acc, b: F.struct(
            (acc["at"] + F.length(b["block"])).alias("at"),
            (acc["line"] + newline_count(b["block"])).alias("line"),
            F.array_append(acc["seen"], F.struct(acc["at"].alias("at"), acc["line"].alias("line"))).alias("seen")),
        lambda acc: acc["seen"])
    windows = cut.select(key, *carry, "page_number", F.posexplode(F.zip_with(
        "_cut", starts, lambda c, s: F.struct(
            c["content"].alias("content"), s["at"].alias("at"), s["line"].alias("line")))).alias("_w", "_s"))
    chunks = windows.select(key, *carry, "page_number", "_w", F.col("_s.at").alias("char_start"),
                            F.col("_s.line").alias("line_start"), F.col("_s.content").alias("content"))
    if page_col is None:
        numbered = chunks.withColumn("chunk_index", F.col("_w"))
    else:
        per_page = base.groupBy(key, F.coalesce("page_number", F.lit(0)).alias("_page")).agg(F.sum(count).alias("_in_page"))
        numbered = number_across_pages(chunks, per_page, key)
    return numbered.select(key, *carry, "chunk_index", "page_number", "char_start",
                           (F.col("char_start") + F.length("content")).alias("char_end"),
                           "line_start", "content")


def number_across_pages(chunks: DataFrame, per_page: DataFrame, key: str) -> DataFrame:
    """``chunk_index`` over the pages of a source, in page order, from chunk counts per page.

    Running totals go over blocks of pages first and over the pages of one block second, so no
    task ever holds all pages of a very large source.
    """
    page = F.coalesce(F.col("page_number"), F.lit(0))
    per_page = per_page.withColumn("_block", F.floor(F.col("_page") / PAGE_BLOCK))
    per_block = per_page.groupBy(key, "_block").agg(F.sum("_in_page").alias("_in_block"))
    block_start = per_block.select(key, "_block", F.coalesce(
        F.sum("_in_block").over(W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0)).alias("_block_start"))
    page_start = per_page.withColumn("_page_start", F.coalesce(
        F.sum("_in_page").over(W.partitionBy(key, "_block").orderBy("_page").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0))).join(block_start, [key, "_block"])
    offsets = page_start.select(key, "_page", (F.col("_block_start") + F.col("_page_start")).alias("_offset"))
    return (chunks.withColumn("_page", page).join(offsets, [key, "_page"])
            .withColumn("chunk_index", (F.col("_offset") + F.col("_w")).cast("int")))


def chunk_chars(df: DataFrame, size: int = 400, overlap: int = 0, *, text_col: str = "text") -> DataFrame:
    """Character windows: every other column, ``chunk_index``, ``char_start`` and ``content``."""
    step = _check(size, overlap)
    others = [c for c in df.columns if c != text_col]
    n = _window_count(F.length(text_col), size, step)
    cut = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda w: F.substring(
        F.col(text_col), w * step + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))
    return (df.select(*others, F.posexplode(cut).alias("chunk_index", "content"))
            .select(*others, "chunk_index", (F.col("chunk_index") * step).alias("char_start"), "content"))

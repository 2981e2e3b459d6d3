"""Corpus synchronisation: listing diff, text, chunks, vectors, replacement per path, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from mnemospark.functions.paths import basename, extension
from mnemospark.operators.chunking import TOKEN_LIMIT, TOKEN_OVERLAP, chunk_tokens
from mnemospark.operators.embedding import Embedder, embed
from mnemospark.operators.listing import diff_listing
from mnemospark.session import durable, sized
from mnemospark.sources.objects import PARSER_EXTENSIONS, text_from_objects, too_large

CHUNK_SCHEMA = ("source_path string, chunk_index int, content string, embedding array<double>, "
                "page_number int, char_start int, char_end int, line_start int, etag string, filename string")


@dataclass(frozen=True)
class SyncResult:
    """New chunk table, the classified listing, a one-row report, and the ledger of files for the next run.

    ``stale`` names the paths whose chunks go, ``fresh`` holds the chunks that come: what a table that is
    updated in place needs instead of ``chunks``.
    """

    chunks: DataFrame
    changes: DataFrame
    report: DataFrame
    files: DataFrame | None = None
    stale: DataFrame | None = None
    fresh: DataFrame | None = None


def chunk_objects(objects: DataFrame, *, limit: int = TOKEN_LIMIT, overlap: int = TOKEN_OVERLAP,
                  embedder: Embedder | None = None, dims: int = 64, error: str | None = None) -> DataFrame:
    """Chunk rows of objects ``(path, etag, content)``; with ``error``, a chunk that cannot be embedded says why there."""
    texts = text_from_objects(objects.select("path", "etag", "content"))
    cut = chunk_tokens(texts, limit, overlap, key="path", carry=("etag",))
    return (embed(cut, "content", embedder, dims, error=error).withColumnRenamed("path", "source_path")
            .withColumn("filename", basename("source_path"))
            .select("source_path", "chunk_index", "content", "embedding", "page_number", "char_start",
                    "char_end", "line_start", "etag", "filename", *([error] if error else [])))


def sync(objects: DataFrame, chunks: DataFrame, *, prefix: str = "", dry_run: bool = False,
         max_bytes: int | None = None, limit: int = TOKEN_LIMIT, overlap: int = TOKEN_OVERLAP,
         embedder: Embedder | None = None, dims: int = 64,
         load: Callable[[DataFrame], DataFrame] | None = None, files: DataFrame | None = None) -> SyncResult:
    """Bring the chunk table in line with the objects ``(path, etag, length, content)``.

    New and changed objects are re-chunked and replace all their old chunks; chunks of vanished
    objects go; unchanged objects are neither read nor moved. Too large objects count as failed
    and keep no chunks; so do formats that need a parser. ``files(path, etag, status)`` is the
    ledger that an earlier run returned: with it, objects that gave no chunk are known too, and a second
    run changes nothing. Without it the chunks tell what is known. ``load(paths)`` fetches the
    objects to process, where a listing is cheaper than a scan with content.
    """
    seen = objects.filter(F.col("path").startswith(prefix)) if prefix else objects
    mine = chunks.filter(F.col("source_path").startswith(prefix)) if prefix else chunks
    # The comparison holds paths and ETags only; it is written once and drives everything below.
    known = mine.select(F.col("source_path").alias("path"), "etag")
    if files is not None:
        known = files.filter(F.col("path").startswith(prefix)).select("path", "etag")
    compared = diff_listing(seen, known)
    changes = durable(compared.join(seen.select("path", "length"), "path", "left"))
    todo = sized(changes.filter(F.col("change").isin("created", "updated")).select("path"))
    stale = sized(changes.filter(F.col("change").isin("updated", "deleted")).select(F.col("path").alias("source_path")))
    pending = load(todo) if load is not None else seen.join(todo, "path", "left_semi")
    fitting = pending.filter(~too_large(max_bytes))
    fresh = chunk_objects(fitting, limit=limit, overlap=overlap, embedder=embedder, dims=dims, error="error" if embedder else None)
    broken = None
    if embedder is not None and not dry_run:
        # Written once: the caller's model runs once per text, and the report counts what it gave.
        fresh = durable(fresh)
        broken = sized(fresh.filter("error IS NOT NULL").select("source_path").distinct())
        fresh = fresh.join(broken, "source_path", "left_anti").drop("error").select(*chunks.columns)
    is_todo, unread = F.col("change").isin("created", "updated"), too_large(max_bytes) | extension("path").isin(*PARSER_EXTENSIONS)
    counts = changes.agg(
        F.count(F.col("etag")).alias("seen"),
        F.sum(F.when(F.col("change") == "unchanged", 1).otherwise(0)).alias("skipped"),
        F.sum(F.when(is_todo & unread, 1).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("change") == "deleted", 1).otherwise(0)).alias("deleted"))
    if dry_run:
        report = counts.select("seen", "skipped", F.lit(0).cast("bigint").alias("failed"),
                               F.lit(0).cast("bigint").alias("files_processed"),
                               F.lit(0).cast("bigint").alias("chunks_written"))
        return SyncResult(chunks, changes, report, files)
    if broken is not None:
        counts = counts.withColumn("failed", F.col("failed") + broken.agg(F.count("*")).scalar())
    per_file = fresh.groupBy("source_path").agg(F.count("*").alias("n"))
    report = counts.select("seen", "skipped", "failed", per_file.agg(F.count("*").alias("n")).scalar().alias("files_processed"),
                           F.coalesce(per_file.agg(F.sum("n").alias("n")).scalar(), F.lit(0)).alias("chunks_written"))
    kept = chunks.join(stale, "source_path", "left_anti")
    # Every object that is there now, with what came of it.
    status = F.when(~is_todo, "kept").when(unread | F.col("_broken"), "failed").when(F.col("n").isNull(), "empty").otherwise("done")
    seen_now = changes.filter(F.col("change") != "deleted").withColumn("_broken", F.lit(False))
    if broken is not None:
        seen_now = seen_now.drop("_broken").join(broken.select(F.col("source_path").alias("path"), F.lit(True).alias("_b")), "path", "left").withColumn("_broken", F.coalesce("_b", F.lit(False)))
    ledger = (seen_now.join(per_file.withColumnRenamed("source_path", "_path"), F.col("path") == F.col("_path"), "left")
              .select("path", "etag", status.alias("status")))
    return SyncResult(kept.unionByName(fresh), changes, report, ledger, stale, fresh)

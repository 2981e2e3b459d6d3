"""Full-text search: an inverted index as a table and BM25 over it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mnemospark.functions.text import distinct_tokens, term_counts, tokens
from mnemospark.operators.ranking import rounded, top_k
from mnemospark.operators.text_scan import BlockScan, asked_terms, counted_blocks, scan_topk
from mnemospark.session import durable, few, sized

# Okapi BM25 constants (Robertson & Zaragoza, 2009).
K1 = 1.2
B = 0.75

TERM_BOUND = 1_000_000  # most query terms that travel to every task


@dataclass(frozen=True)
class TextIndex:
    """``postings(id, field, term, tf, doc_len)`` and ``stats(field, n_docs, avg_len)``.

    ``doc_len`` rides on every posting, so scoring never joins a document table.
    """

    postings: DataFrame
    stats: DataFrame
    fields: tuple[str, ...]

    def save(self, root: str, buckets: int = 0) -> None:
        """Write both tables; ``buckets`` range-clusters postings by term so files skip by min/max."""
        postings = self.postings
        if buckets:
            postings = postings.repartitionByRange(buckets, "term", "id").sortWithinPartitions("term", "id")
        postings.write.mode("overwrite").parquet(f"{root}/postings")
        self.stats.write.mode("overwrite").parquet(f"{root}/stats")

    @staticmethod
    def load(spark: SparkSession, root: str) -> "TextIndex":
        stats = spark.read.parquet(f"{root}/stats")
        fields = tuple(sorted(r["field"] for r in stats.select("field").collect()))  # one row per field
        return TextIndex(spark.read.parquet(f"{root}/postings"), stats, fields)

    def statistic(self, name: str) -> Column:
        return statistic(self.stats, self.fields, name)


def statistic(stats: DataFrame, fields: Sequence[str], name: str) -> Column:
    """``n_docs`` or ``avg_len`` of the posting's field, as scalar subqueries rather than a join."""
    out = F.lit(None).cast("double")
    for field in fields:
        value = stats.filter(F.col("field") == field).select(F.col(name).cast("double")).scalar()
        out = value if len(fields) == 1 else F.when(F.col("field") == field, value).otherwise(out)
    return out


def bm25_idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def _idf(n_docs: np.ndarray, df: np.ndarray) -> np.ndarray:
    return np.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_part(tf: Column, doc_len: Column, avg_len: Column) -> Column:
    """What one term of a document is worth, apart from the rarity of the term; of columns or of arrays."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * (doc_len / avg_len)))


def _fields(corpus: DataFrame, fields: Sequence[str], keyword_fields: Sequence[str], id_col: str, *more: Column) -> DataFrame:
    """One row per document and field, with its token array; one scan for all fields."""
    parts = [F.struct(F.lit(f).alias("field"), tokens(F.col(f"`{f}`").cast("string")).alias("toks")) for f in fields]
    parts += [F.struct(F.lit(f).alias("field"), F.array(F.col(f"`{f}`").cast("string")).alias("toks")) for f in keyword_fields]
    one = parts[0] if len(parts) == 1 else F.explode(F.array(*parts))
    return corpus.select(F.col(id_col).alias("id"), *more, one.alias("p")).select("id", *more, "p.field", "p.toks")


def _terms(docs: DataFrame, *more: str, only_terms: DataFrame | None = None) -> DataFrame:
    """``(id, ..., field, term, tf, doc_len)``, counted within each row; nothing is shuffled."""
    # explode_outer: a plain explode makes the optimizer test the counts first, which would cut every text a second time.
    each = docs.select("id", *more, "field", F.explode_outer(term_counts(F.col("toks"))).alias("t"))
    words = each.select("id", *more, "field", "t.*").filter("term IS NOT NULL")
    return words if only_terms is None else words.join(only_terms, "term", "left_semi")


def _stats(docs: DataFrame) -> DataFrame:
    sizes = docs.select("field", F.size("toks").alias("doc_len"))
    filled = F.when(F.col("doc_len") > 0, F.col("doc_len"))
    return sizes.groupBy("field").agg(F.count(filled).alias("n_docs"), F.avg(filled).alias("avg_len"))


def build_text_index(corpus: DataFrame, fields: Sequence[str], *, keyword_fields: Sequence[str] = (),
                     id_col: str = "id", only_terms: DataFrame | None = None) -> TextIndex:
    """Index ``fields`` word by word and ``keyword_fields`` as whole values.

    Every row is a document; words are counted where the row is. ``only_terms(term)``, distinct, keeps
    the postings of those terms only.
    """
    docs = _fields(corpus, fields, keyword_fields, id_col)
    postings = _terms(docs, only_terms=only_terms)
    return TextIndex(postings.select("id", "field", "term", "tf", "doc_len"), _stats(docs), tuple([*fields, *keyword_fields]))


def query_terms(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    return queries.select(F.col(query_id).alias("query_id"), F.explode(distinct_tokens(text)).alias("term"))


def _sized(terms: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Broadcast hint for tables with at most one row per query term and field, if the terms are few.

    The check runs on the queries alone. Above the bound nothing is hinted and Spark joins by
    shuffle, splitting the partitions of very common terms.
    """
    return F.broadcast if terms.limit(TERM_BOUND + 1).count() <= TERM_BOUND else (lambda df: df)


def bm25_scores(queries: DataFrame, index: TextIndex, *, query_id: str = "query_id",
                text: str = "text", fields: Sequence[str] | None = None,
                keep_ids: DataFrame | None = None) -> DataFrame:
    """``(query_id, id, score)`` for every document that shares a term with the query.

    Statistics cover the whole index; ``keep_ids`` drops documents before they are scored.
    """
    terms = query_terms(queries, query_id, text)
    sized = _sized(terms)
    postings = index.postings
    if fields is not None:
        postings = postings.filter(F.col("field").isin(*fields))
    # Document frequencies of the asked terms only; the semi join keeps the rest out of the count.
    asked = postings.join(sized(terms.select("term").distinct()), "term", "left_semi")
    frequency = asked.groupBy("field", "term").agg(F.count("*").alias("df"))
    # One row per query term and field with its weight: a small table beside the postings.
    weighted = frequency.join(sized(terms), "term").select(
        "query_id", "field", "term", "df")
    if keep_ids is not None:
        postings = postings.join(keep_ids.select("id"), "id", "left_semi")
    gain = bm25_idf(index.statistic("n_docs"), F.col("df")) * bm25_part(F.col("tf"), F.col("doc_len"), index.statistic("avg_len"))
    return (postings.join(sized(weighted), ["field", "term"])
            .groupBy("query_id", "id").agg(rounded(F.sum(gain)).alias("score")))


# ---- blocks: the first k without scoring every match --------------------------------------

BLOCK_DOCS = 64  # documents of a block
FIRST_BLOCKS = 8  # blocks per query that are scored to learn what its k-th score is at least
SLACK = 1e-5  # more than rounding can move a score


@dataclass(frozen=True)
class BlockIndex:
    """``blocks(field, term, block, df, most, hits)`` and ``stats``: postings by term and block of documents.

    ``hits`` are ``(id, tf, doc_len)``, ``df`` their number and ``most`` the largest ``bm25_part`` among them. A document
    belongs to one block with all its fields, so the terms' ``most`` bound what any document of a block can score.
    """

    blocks: DataFrame
    stats: DataFrame
    fields: tuple[str, ...]

    def save(self, root: str, files: int = 0) -> None:
        """Write both tables; ``files`` range-clusters the blocks by term so that files skip by min/max."""
        blocks = self.blocks
        if files:
            blocks = blocks.repartitionByRange(files, "term", "block").sortWithinPartitions("term", "block")
        blocks.write.mode("overwrite").parquet(f"{root}/blocks")
        self.stats.write.mode("overwrite").parquet(f"{root}/stats")

    @staticmethod
    def load(spark: SparkSession, root: str) -> "BlockIndex":
        stats = spark.read.parquet(f"{root}/stats")
        fields = tuple(sorted(r["field"] for r in stats.select("field").collect()))  # one row per field
        return BlockIndex(spark.read.parquet(f"{root}/blocks"), stats, fields)


def build_block_index(corpus: DataFrame, fields: Sequence[str], *, keyword_fields: Sequence[str] = (),
                      id_col: str = "id", only_terms: DataFrame | None = None) -> BlockIndex:
    """Index like ``build_text_index``, in blocks. Rows that stand together share a block; no key is larger than a block.

    Write the result before use, here or with ``save``: the blocks are drawn by the scan, and counted in its tasks.
    """
    names = tuple([*fields, *keyword_fields])
    stats = durable(_stats(_fields(corpus, fields, keyword_fields, id_col)))
    known = {r["field"]: r["avg_len"] for r in stats.collect()}  # one row per field
    averages = [known.get(f) or 1.0 for f in names]
    rows = corpus.select(F.col(id_col).alias("id"), *[tokens(F.col(f"`{f}`").cast("string")).alias(f"_{i}") for i, f in enumerate(fields)],
                         *[F.array(F.col(f"`{f}`").cast("string")).alias(f"_k{i}") for i, f in enumerate(keyword_fields)])
    blocks = counted_blocks(rows, names, averages, bm25_part, BLOCK_DOCS)
    return BlockIndex(blocks if only_terms is None else blocks.join(only_terms, "term", "left_semi"), stats, names)


def _weighted(terms: DataFrame, index: BlockIndex, blocks: DataFrame) -> DataFrame:
    """``(query_id, field, term, idf)`` of the asked terms that occur."""
    sized = _sized(terms)
    frequency = blocks.join(sized(terms.select("term").distinct()), "term", "left_semi").groupBy("field", "term").agg(F.sum("df").alias("df"))
    idf = bm25_idf(statistic(index.stats, index.fields, "n_docs"), F.col("df"))
    return sized(durable(frequency.withColumn("idf", idf).join(sized(terms), "term").select("query_id", "field", "term", "idf")))


def block_bounds(weighted: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(query_id, block, bound)``: what no document of the block exceeds. Reads no hits."""
    return (blocks.select("field", "term", "block", "most").join(weighted, ["field", "term"])
            .groupBy("query_id", "block").agg(F.sum(F.col("idf") * F.col("most")).alias("bound")))


def _open(opened: DataFrame, weighted: DataFrame, index: BlockIndex, blocks: DataFrame, keep_ids: DataFrame | None) -> DataFrame:
    """Exact ``(query_id, id, score)`` of the documents in the opened ``(query_id, block)``."""
    asked = opened.select("query_id", "block").join(weighted, "query_id")
    hits = (blocks.select("field", "term", "block", "hits").join(asked, ["field", "term", "block"])
            .select("query_id", "field", "idf", F.explode("hits").alias("h")).select("query_id", "field", "idf", "h.*"))
    if keep_ids is not None:
        hits = hits.join(keep_ids.select("id"), "id", "left_semi")
    part = bm25_part(F.col("tf"), F.col("doc_len"), statistic(index.stats, index.fields, "avg_len"))
    return hits.groupBy("query_id", "id").agg(rounded(F.sum(F.col("idf") * part)).alias("score"))


def pruned_topk(queries: DataFrame, index: BlockIndex, k: int, *, fields: Sequence[str] | None = None,
                query_id: str = "query_id", text: str = "text", keep_ids: DataFrame | None = None,
                opened: list[DataFrame] | None = None) -> DataFrame:
    """The first ``k`` of ``bm25_scores``, opening only blocks that can hold one of them.

    A first pass scores the ``FIRST_BLOCKS`` blocks with the highest bounds; their k-th score is a floor for the query.
    A second pass scores the other blocks whose bound reaches the floor. ``opened`` receives the ``(query_id, block)`` of
    both passes.
    """
    blocks = index.blocks if fields is None else index.blocks.filter(F.col("field").isin(*fields))
    # In a struct, so that a null id joins like any other.
    terms = query_terms(queries, query_id, text).withColumn("query_id", F.struct(F.col("query_id").alias("of")))
    weighted = _weighted(terms, index, blocks)
    told = weighted.limit(TERM_BOUND + 1).collect()
    if len(told) > TERM_BOUND:
        return _pruned_pairs(weighted, index, blocks, k, keep_ids, opened)
    if not told:
        return _open(weighted.withColumn("block", F.lit(0).cast("bigint")), weighted, index, blocks, None).withColumn("rank", F.lit(0)).withColumn("query_id", F.col("query_id.of"))
    averages = {r["field"]: r["avg_len"] for r in index.stats.collect()}  # one row per field
    kept = blocks if keep_ids is None else (
        blocks.select("field", "term", "block", "most", F.explode("hits").alias("h")).withColumn("id", F.col("h.id"))
        .join(keep_ids.select("id"), "id", "left_semi").groupBy("field", "term", "block").agg(F.max("most").alias("most"), F.collect_list("h").alias("hits")))
    scan = BlockScan(kept, [tuple(r) for r in told], averages, bm25_part, SLACK)
    asked_kind = weighted.schema["query_id"].dataType
    first = few(scan.named(scan.first(FIRST_BLOCKS), asked_kind).select("query_id", "block"))
    best = durable(top_k(_open(first, weighted, index, blocks, keep_ids), k))
    floors = {r["query_id"]: r["score"] for r in best.filter(F.col("rank") == k).select("query_id", "score").collect()}
    done = [tuple(r) for r in first.collect()]  # at most FIRST_BLOCKS rows per query
    if opened is not None:
        opened += [pairs.select(F.col("query_id.of").alias("query_id"), "block") for pairs in (first, scan.named(scan.open_pairs(floors, done), asked_kind))]
    rest = scan.named(scan.rest(k, floors, done, best.schema["id"].dataType), asked_kind).select("query_id", "id", "score")
    return top_k(best.drop("rank").unionByName(rest), k).withColumn("query_id", F.col("query_id.of"))


def _pruned_pairs(weighted: DataFrame, index: BlockIndex, blocks: DataFrame, k: int, keep_ids: DataFrame | None, opened: list[DataFrame] | None) -> DataFrame:
    """The same by joins, for more query terms than travel to every task."""
    bounds = durable(block_bounds(weighted, blocks))
    first = few(top_k(bounds, FIRST_BLOCKS, score="bound", id_col="block").select("query_id", "block"))
    best = durable(top_k(_open(first, weighted, index, blocks, keep_ids), k))
    floor = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    rest = (bounds.join(first, ["query_id", "block"], "left_anti").join(sized(floor), "query_id", "left")
            .filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - SLACK)))
    if opened is not None:
        opened += [pairs.select(F.col("query_id.of").alias("query_id"), "block") for pairs in (first, rest)]
    ranked = top_k(best.drop("rank").unionByName(_open(rest, weighted, index, blocks, keep_ids)), k)
    return ranked.withColumn("query_id", F.col("query_id.of"))


def bm25_topk(queries: DataFrame, corpus: DataFrame | TextIndex | BlockIndex, k: int | None = None, *,
              fields: Sequence[str] = ("text",), id_col: str = "id", query_id: str = "query_id",
              text: str = "text", keep_ids: DataFrame | None = None, include_scores: bool = True,
              post_filter: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Documents matching any query word, best first; ``k=None`` returns all matches.

    Scores use whole-index statistics. ``keep_ids(id)`` is the filter: it applies to the matches
    and before the limit. With a limit, a ``BlockIndex`` is searched by its bounds, and a corpus in one
    scan that moves no pair of query and document.
    """
    wanted, asked = None, None
    if isinstance(corpus, (TextIndex, BlockIndex)):
        index, wanted = corpus, list(fields) if fields else None
    else:
        if k is not None and keep_ids is None:
            asked = asked_terms(queries, TERM_BOUND, query_id, text)
        if asked is None:
            terms = query_terms(queries, query_id, text)
            index = build_text_index(corpus, fields, id_col=id_col, only_terms=_sized(terms)(terms.select("term").distinct()))
    if asked is not None:
        hits = scan_topk(asked, queries, corpus, k, fields, id_col, query_id, _idf, bm25_part)
        hits = hits if include_scores else hits.drop("score")
        return hits if post_filter is None else hits.transform(post_filter)
    if isinstance(index, BlockIndex) and k is None:
        each = index.blocks.select("field", "term", F.explode("hits").alias("h")).select("h.id", "field", "term", "h.tf", "h.doc_len")
        index = TextIndex(each, index.stats, index.fields)
    if isinstance(index, BlockIndex):
        hits = pruned_topk(queries, index, k, fields=wanted, query_id=query_id, text=text, keep_ids=keep_ids)
    else:
        hits = top_k(bm25_scores(queries, index, query_id=query_id, text=text, fields=wanted, keep_ids=keep_ids), k)
    hits = hits.select("query_id", "id", "rank", "score")
    if not include_scores:
        hits = hits.drop("score")
    return hits if post_filter is None else hits.transform(post_filter)


def first_in_scope(queries: DataFrame, corpus: DataFrame, k: int, scope: Column, also: DataFrame | None, *, fields: Sequence[str] = ("text",)) -> DataFrame | None:
    """``bm25_topk`` of the documents in scope, with the statistics of all, and the ranks of the ``also(query_id, id)`` that match.

    One scan; no pair of query and document moves. ``None`` if there are more query terms than travel to every task.
    """
    asked = asked_terms(queries, TERM_BOUND)
    if asked is None:
        return None
    pairs = [] if also is None else [tuple(r) for r in also.select("query_id", "id").collect()]
    return scan_topk(asked, queries, corpus, k, fields, "id", "query_id", _idf, bm25_part, scope, pairs)


def matching_ids(corpus: DataFrame, predicate: Column, id_col: str = "id") -> DataFrame:
    """Ids of the rows that satisfy a filter, for ``keep_ids``."""
    return corpus.filter(predicate).select(F.col(id_col).alias("id"))

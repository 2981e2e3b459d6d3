"""Shared inputs of the registered queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mnemospark.plans.registry import Tables

# ---- SQL fragments ------------------------------------------------------------------------


def toks(expr: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({expr}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def cos_score(a: str, b: str) -> str:
    return f"round((1 + list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[])) / 2, 6)"


CENTROIDS = """
cen AS (
  SELECT label AS query_id, list(v ORDER BY i) AS vector
  FROM (SELECT label, i, avg(e) AS v
        FROM (SELECT label, unnest(embedding)::DOUBLE AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)
        GROUP BY label, i)
  GROUP BY label)"""


def ranked(source: str, k: int | None = None, extra: str = "") -> str:
    """Rank ``source(query_id, id, score)``; keep ``k``."""
    keep = f"WHERE rank <= {k}" if k else ""
    return f"""SELECT * FROM (SELECT query_id, id,
      (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS rank, score{extra}
      FROM {source}) {keep}"""


def bm25(queries: str, docs: str, prefix: str = "") -> str:
    """CTEs ``{prefix}bm(query_id, id, score)`` for ``queries(query_id, text)`` over ``docs(id, field, text)``."""
    p = prefix
    return f"""
{p}dt AS (SELECT id, field, {toks('text')} AS toks FROM {docs}),
{p}dl AS (SELECT id, field, len(toks) AS doc_len FROM {p}dt WHERE len(toks) > 0),
{p}st AS (SELECT field, count(*) AS n_docs, avg(doc_len) AS avg_len FROM {p}dl GROUP BY field),
{p}po AS (SELECT id, field, term, count(*) AS tf FROM (SELECT id, field, unnest(toks) AS term FROM {p}dt) GROUP BY ALL),
{p}df AS (SELECT field, term, count(*) AS df FROM {p}po GROUP BY ALL),
{p}qt AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest({toks('text')}) AS term FROM {queries})),
{p}bm AS (
  SELECT query_id, id, round(sum(ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
         / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * doc_len / avg_len))), 6) AS score
  FROM {p}qt JOIN {p}po USING (term) JOIN {p}df USING (field, term) JOIN {p}st USING (field) JOIN {p}dl USING (id, field)
  GROUP BY query_id, id)"""


def hashed(expr: str, dims: int = 64) -> str:
    """Hashed token features at unit length, as a list."""
    bucket = f"(('0x' || substr(md5(t), 1, 8))::BIGINT % {dims})"
    return f"""(SELECT CASE WHEN max(c) = 0 THEN list(0.0::DOUBLE ORDER BY d)
      ELSE list(c / sqrt(n) ORDER BY d) END
      FROM (SELECT d, c, sum(c * c) OVER () AS n FROM (
        SELECT d, (len(list_filter(b, lambda x: x = d)))::DOUBLE AS c
        FROM (SELECT list_transform({toks(expr)}, lambda t: {bucket}) AS b), range({dims}) r(d))))"""


# ---- Spark inputs -------------------------------------------------------------------------


def docs(t: Tables) -> DataFrame:
    return t.spread("documents", "doc_id", "text", "lang", "source", "n_chars").withColumnRenamed("doc_id", "id")


def vecs(t: Tables) -> DataFrame:
    return t.embeddings.withColumnRenamed("vec_id", "id")


def centroids(t: Tables) -> DataFrame:
    """One query per label: the mean vector of all its rows (a group is one label and dimension)."""
    means = (t.embeddings.select("label", F.posexplode("embedding").alias("i", "e"))
             .groupBy("label", "i").agg(F.avg(F.col("e").cast("double")).alias("v")))
    packed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("p"))
    return packed.select(F.col("label").alias("query_id"), F.transform("p", lambda x: x["v"]).alias("vector"))


def text_queries(t: Tables) -> DataFrame:
    """Every benchmark passage as a query."""
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text")


TEXT_QUERIES = "tq AS (SELECT item_id AS query_id, text FROM benchmark)"


def hybrid_queries(t: Tables) -> DataFrame:
    """Every benchmark passage with the vector of the same number."""
    v = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return text_queries(t).join(v, "query_id")


HYBRID_QUERIES = """hq AS (SELECT item_id AS query_id, text, embedding AS vector
  FROM benchmark JOIN embeddings ON item_id = vec_id)"""


def hybrid_corpus(t: Tables) -> DataFrame:
    """Documents and vectors side by side; either may be missing."""
    return docs(t).join(vecs(t), "id", "full_outer")


def object_path() -> "F.Column":
    return F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


OBJECT_PATH = "source || '/' || lang || '/' || doc_id || '.txt'"


def objects(t: Tables) -> DataFrame:
    """Documents as objects."""
    content = F.col("text").cast("binary")
    texts = t.spread("documents", "doc_id", "source", "lang", "text")
    return texts.select(object_path().alias("path"), F.md5(content).alias("etag"),
                              F.length(content).cast("bigint").alias("length"), content.alias("content"))


URL_PATH = "regexp_replace(url, '^https?://', '')"


def url_paths(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_replace("url", "^https?://", "").alias("source_path"))

"""Registered queries: vector, text and hybrid retrieval."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mnemospark.functions.vectors import cosine_similarity
from mnemospark.operators import chunking, embedding, hybrid, mmr, parents, text_search, vector_search
from mnemospark.operators.ranking import first_per_key, top_k
from mnemospark.plans import fragments as fr
from mnemospark.plans.registry import query
from mnemospark.session import durable, ensure_checkpoint_dir

V1_HITS = f"""
{fr.CENTROIDS},
sc AS (SELECT query_id, vec_id AS id, {fr.cos_score('vector', 'embedding')} AS score FROM cen, embeddings),
hits AS ({fr.ranked('sc', 10)})"""


def v1_hits(t):
    return vector_search.vector_topk(fr.centroids(t), fr.vecs(t), 10)


@query("v1_vector_topk", f"WITH {V1_HITS} SELECT query_id, id, rank, score FROM hits")
def _(t):
    return v1_hits(t)


@query("v2_metrics", f"""WITH {fr.CENTROIDS},
sc AS (
  SELECT 'cosine' AS metric, query_id, vec_id AS id, {fr.cos_score('vector', 'embedding')} AS score FROM cen, embeddings
  UNION ALL SELECT 'dotProduct', query_id, vec_id, round((1 + list_dot_product(vector, embedding::DOUBLE[])) / 2, 6) FROM cen, embeddings
  UNION ALL SELECT 'euclidean', query_id, vec_id, round(1 / (1 + list_distance(vector, embedding::DOUBLE[])), 6) FROM cen, embeddings)
SELECT metric, query_id, id, rank, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY metric, query_id ORDER BY score DESC, id))::INT AS rank FROM sc) WHERE rank <= 5""")
def _(t):
    out = None
    for metric in ("cosine", "dotProduct", "euclidean"):
        one = vector_search.vector_topk(fr.centroids(t), fr.vecs(t), 5, metric=metric).withColumn("metric", F.lit(metric))
        out = one if out is None else out.unionByName(one)
    return out


@query("v3_ann_topk")
def _(t):
    cells, pivots = vector_search.build_cells(fr.vecs(t), 32)
    return vector_search.ann_topk(fr.centroids(t), cells, pivots, 10, oversampling=10)


@query("v4_cosine_similarity", f"""WITH {fr.CENTROIDS}
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], vector), 6) AS similarity
FROM embeddings JOIN cen ON label = query_id""")
def _(t):
    joined = t.embeddings.join(fr.centroids(t).withColumnRenamed("query_id", "label"), "label")
    return joined.select("vec_id", F.round(cosine_similarity("embedding", "vector"), 6).alias("similarity"))


def _mmr_sql(k: int, fetch_k: int, balance: float) -> str:
    """Greedy selection unrolled: one step per pick."""
    steps = []
    for n in range(1, k + 1):
        if n == 1:
            value, picked = "rel", None
        else:
            union = " UNION ALL ".join(f"SELECT query_id, id, v FROM s{m}" for m in range(1, n))
            steps.append(f"p{n} AS ({union})")
            picked = f"p{n}"
            value = (f"({balance} * rel - {1 - balance} * (SELECT max(list_cosine_similarity(c.v, p.v)) "
                     f"FROM p{n} p WHERE p.query_id = c.query_id))")
        skip = "" if picked is None else f"WHERE NOT EXISTS (SELECT 1 FROM {picked} p WHERE p.query_id = c.query_id AND p.id = c.id)"
        steps.append(f"""s{n} AS (SELECT * FROM (SELECT query_id, id, v, score, {n}::INT AS pick,
          row_number() OVER (PARTITION BY query_id ORDER BY val DESC, rank) AS o
          FROM (SELECT c.*, {value} AS val FROM cand c {skip})) WHERE o = 1)""")
    result = " UNION ALL ".join(f"SELECT query_id, id, pick AS rank, score FROM s{n}" for n in range(1, k + 1))
    return f"""WITH {fr.CENTROIDS},
sc AS (SELECT query_id, vec_id AS id, {fr.cos_score('vector', 'embedding')} AS score FROM cen, embeddings),
hits AS ({fr.ranked('sc', fetch_k)}),
cand AS (SELECT h.*, embedding::DOUBLE[] AS v, list_cosine_similarity(embedding::DOUBLE[], vector) AS rel
         FROM hits h JOIN embeddings ON id = vec_id JOIN cen USING (query_id)),
{', '.join(steps)} {result}"""


@query("v5_mmr", _mmr_sql(4, 20, 0.5))
def _(t):
    return mmr.mmr(fr.centroids(t), fr.vecs(t), 4, 20, 0.5)


@query("v6_embed", f"""
WITH e AS (SELECT doc_id, {fr.hashed('text')} AS v FROM documents)
SELECT doc_id, (i - 1)::INT AS dim, round(x, 6) AS value
FROM (SELECT doc_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e)""")
def _(t):
    # posexplode_outer: a plain one makes the optimizer test the vector first, computing it twice.
    return (embedding.embed(t.spread("documents", "doc_id", "text"), "text", dims=64)
            .select("doc_id", F.posexplode_outer("embedding").alias("dim", "value"))
            .withColumn("value", F.round("value", 6)))


@query("v7_relevance_threshold", f"WITH {V1_HITS} SELECT query_id, id, rank, score FROM hits WHERE score >= 0.55")
def _(t):
    return vector_search.above_threshold(v1_hits(t), 0.55)


# ---- filters around the search --------------------------------------------------------------

def _structured() -> list[dict]:
    """One structured query per label: others only for even labels, the label and above for odd ones."""
    return [{"query_id": n, "limit": 3 + n % 3,
             "filter": {"label": {"$ne": n}} if n % 2 == 0 else {"label": {"$gte": n}}} for n in range(10)]


@query("p3_filtered_vector_search", f"""WITH {fr.CENTROIDS},
sc AS (SELECT query_id, vec_id AS id, {fr.cos_score('vector', 'embedding')} AS score FROM cen, embeddings
       WHERE CASE WHEN query_id % 2 = 0 THEN label <> query_id OR label IS NULL ELSE label >= query_id END),
hits AS ({fr.ranked('sc')})
SELECT query_id, id, rank, score FROM hits WHERE rank <= 3 + query_id % 3""")
def _(t):
    return vector_search.filtered_vector_search(_structured(), fr.centroids(t), fr.vecs(t))


@query("p5_post_filter", f"""WITH {V1_HITS}
SELECT query_id, id, rank, score, label FROM hits JOIN embeddings ON id = vec_id WHERE label = query_id""")
def _(t):
    def same_label(hits):
        labels = t.embeddings.select(F.col("vec_id").alias("id"), "label")
        return hits.join(labels, "id").filter(F.col("label") == F.col("query_id"))
    return vector_search.vector_topk(fr.centroids(t), fr.vecs(t), 10, post_filter=same_label)


@query("p6_without_embeddings", f"""WITH {V1_HITS}
SELECT query_id, id, rank, score, label FROM hits JOIN embeddings ON id = vec_id""")
def _(t):
    return v1_hits(t).join(fr.vecs(t).drop("embedding"), "id")


# ---- text -----------------------------------------------------------------------------------

@query("t1_build_text_index", f"""WITH
dt AS (SELECT doc_id AS id, {fr.toks('text')} AS toks FROM documents)
SELECT id, 'text' AS field, term, count(*) AS tf, doc_len
FROM (SELECT id, unnest(toks) AS term, len(toks)::INT AS doc_len FROM dt) GROUP BY id, term, doc_len""")
def _(t):
    return text_search.build_text_index(fr.docs(t), ["text"]).postings


T2_HITS = f"""{fr.TEXT_QUERIES},
d AS (SELECT doc_id AS id, 'text' AS field, text FROM documents),
{fr.bm25('tq', 'd')}, hits AS ({fr.ranked('bm', 10)})"""


@query("t2_bm25_topk", f"WITH {T2_HITS} SELECT query_id, id, rank, score FROM hits")
def _(t):
    return text_search.bm25_topk(fr.text_queries(t), fr.docs(t), 10)


@query("t2_block_topk", f"WITH {T2_HITS} SELECT query_id, id, rank, score FROM hits")
def _(t):
    """The same from a written block index."""
    root = f"{ensure_checkpoint_dir(t.spark)}/blocks-{uuid.uuid4().hex}"
    text_search.build_block_index(fr.docs(t), ["text"]).save(root, files=16)
    return text_search.bm25_topk(fr.text_queries(t), text_search.BlockIndex.load(t.spark, root), 10)


@query("t3_multi_field", f"""WITH
tq AS (SELECT item_id AS query_id, text || ' src' || (item_id % 20) AS text FROM benchmark),
d AS (SELECT doc_id AS id, 'text' AS field, text FROM documents
      UNION ALL SELECT doc_id, 'source', source FROM documents),
{fr.bm25('tq', 'd')}, hits AS ({fr.ranked('bm', 10)}) SELECT query_id, id, rank, score FROM hits""")
def _(t):
    asked = fr.text_queries(t).withColumn("text", F.concat("text", F.lit(" src"), F.col("query_id") % 20))
    return text_search.bm25_topk(asked, fr.docs(t), 10, fields=["text", "source"])


@query("t2_bm25_filtered", f"""WITH {fr.TEXT_QUERIES},
d AS (SELECT doc_id AS id, 'text' AS field, text FROM documents), {fr.bm25('tq', 'd')},
kept AS (SELECT bm.* FROM bm JOIN documents ON id = doc_id WHERE lang = 'fr' OR n_chars > 3000),
hits AS ({fr.ranked('kept', 5)}) SELECT query_id, id, rank FROM hits""")
def _(t):
    keep = text_search.matching_ids(fr.docs(t), (F.col("lang") == "fr") | (F.col("n_chars") > 3000))
    return text_search.bm25_topk(fr.text_queries(t), fr.docs(t), 5, keep_ids=keep, include_scores=False)


# ---- fusion and reranking ---------------------------------------------------------------------

@query("h1_reciprocal_rank", f"""WITH {V1_HITS}
SELECT query_id, id, rank, round(0.7::DOUBLE / (rank + 60), 6) AS score FROM hits""")
def _(t):
    return hybrid.reciprocal_rank(v1_hits(t), 60, 0.7).withColumn("score", F.round("score", 6))


def _fused_sql(k: int, vw: float, fw: float) -> str:
    return f"""{fr.HYBRID_QUERIES},
vs AS (SELECT query_id, vec_id AS id, {fr.cos_score('vector', 'embedding')} AS score FROM hq, embeddings),
vl AS ({fr.ranked('vs', k)}),
d AS (SELECT doc_id AS id, 'text' AS field, text FROM documents), {fr.bm25('hq', 'd')},
tl AS ({fr.ranked('bm', k)}),
u AS (SELECT query_id, id, {vw}::DOUBLE / (rank + 60) AS vector_score, 0::DOUBLE AS fulltext_score FROM vl
      UNION ALL SELECT query_id, id, 0, {fw}::DOUBLE / (rank + 60) FROM tl),
fu AS (SELECT query_id, id, round(sum(vector_score), 6) AS vector_score, round(sum(fulltext_score), 6) AS fulltext_score,
       round(sum(vector_score + fulltext_score), 6) AS score FROM u GROUP BY query_id, id),
fused AS ({fr.ranked('fu', k, ', vector_score, fulltext_score')})"""


@query("h2_hybrid_topk", f"WITH {_fused_sql(10, 1.0, 1.0)} SELECT query_id, id, rank, vector_score, fulltext_score, score FROM fused")
def hybrid_flagship(t):
    return hybrid.hybrid_topk(fr.hybrid_queries(t), fr.hybrid_corpus(t), 10)


@query("h2_hybrid_zero_weight", f"WITH {_fused_sql(5, 0.0, 1.0)} SELECT query_id, id, rank, vector_score, fulltext_score, score FROM fused")
def _(t):
    return hybrid.hybrid_topk(fr.hybrid_queries(t), fr.hybrid_corpus(t), 5, vector_weight=0.0)


@query("h3_rank_fusion", f"WITH {_fused_sql(20, 0.5, 0.5)} SELECT query_id, id, rank, vector_score, fulltext_score, score FROM fused")
def _(t):
    asked = fr.hybrid_queries(t)
    legs = {"vector": vector_search.vector_topk(asked, fr.vecs(t), 20),
            "fulltext": text_search.bm25_topk(asked, fr.docs(t), 20)}
    return hybrid.rank_fusion(legs, {"vector": 0.5, "fulltext": 0.5}, 20)


def _overlap(q: str, d: str) -> str:
    return f"""round(CASE WHEN len({fr.toks(q)}) = 0 THEN 0 ELSE
      len(list_intersect(list_distinct({fr.toks(q)}), list_distinct({fr.toks(d)})))::DOUBLE / len(list_distinct({fr.toks(q)})) END, 6)"""


@query("h4_rerank", f"""WITH {T2_HITS},
rs AS (SELECT query_id, id, {_overlap('tq.text', 'd.text')} AS score
       FROM hits JOIN d USING (id) JOIN tq USING (query_id)),
rr AS ({fr.ranked('rs', 5)})
SELECT query_id, id, rank, score, score AS rerank_score FROM rr""")
def _(t):
    asked = fr.text_queries(t)
    hits = text_search.bm25_topk(asked, fr.docs(t), 10)
    return hybrid.rerank(hits, asked, fr.docs(t), num_docs=10, k=5).select("query_id", "id", "rank", "score", "rerank_score")


def _windows(n: str, limit: int, step: int) -> str:
    return f"CASE WHEN {n} <= 0 THEN 0 WHEN {n} <= {limit} THEN 1 ELSE (ceil(({n} - {limit}) / {step}::DOUBLE))::BIGINT + 1 END"


CHILDREN = f"""ch AS (SELECT doc_id || '#' || w AS id, doc_id, w::INT AS chunk_index, substr(text, (w * 400 + 1)::BIGINT, 400) AS text
  FROM (SELECT doc_id, text, unnest(range({_windows('length(text)', 400, 400)})) AS w FROM documents))"""


@query("h6_split_children", f"WITH {CHILDREN} SELECT id, doc_id, chunk_index, text FROM ch")
def _(t):
    return parents.split_children(t.documents, 400, id_col="doc_id")


@query("h5_parent_documents", f"""WITH {fr.TEXT_QUERIES}, {CHILDREN},
d AS (SELECT id, 'text' AS field, text FROM ch), {fr.bm25('tq', 'd')}, hits AS ({fr.ranked('bm', 10)}),
pa AS (SELECT query_id, doc_id AS id, max(score) AS score FROM hits JOIN ch USING (id) GROUP BY query_id, doc_id),
rp AS ({fr.ranked('pa')})
SELECT query_id, id, rank, score, lang FROM rp JOIN documents ON id = doc_id""")
def _(t):
    chunks = durable(parents.split_children(t.documents.repartition("doc_id"), 400, id_col="doc_id"))
    hits = text_search.bm25_topk(fr.text_queries(t), chunks, 10)
    found = parents.parent_documents(hits, chunks, t.documents, k=10, parent_id="doc_id")
    return found.select("query_id", "id", "rank", "score", "lang")


# ---- joins, ranks and unions on their own ---------------------------------------------------

@query("j7_similarity_join", f"""WITH {fr.CENTROIDS},
sc AS (SELECT vec_id AS query_id, cen.query_id AS id, {fr.cos_score('embedding', 'vector')} AS score FROM embeddings, cen),
hits AS ({fr.ranked('sc', 1)}) SELECT query_id, id, rank, score FROM hits""")
def _(t):
    asked = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return vector_search.vector_topk(asked, fr.centroids(t).select(F.col("query_id").alias("id"), F.col("vector").alias("embedding")), 1)


@query("w1_rank_in_leg", """SELECT event_type AS query_id, event_id AS id, value AS score,
  (row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id))::INT AS rank FROM events""")
def _(t):
    scored = t.events.select(F.col("event_type").alias("query_id"), F.col("event_id").alias("id"), F.col("value").alias("score"))
    return top_k(scored, None)


@query("w5_topk_per_query", """SELECT * FROM (SELECT o_orderpriority AS query_id, o_orderkey AS id, o_totalprice AS score,
  (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey))::INT AS rank FROM orders) WHERE rank <= 25""")
def _(t):
    scored = t.orders.select(F.col("o_orderpriority").alias("query_id"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"))
    return top_k(scored, 25)


@query("u1_union_of_legs", """SELECT id, max(a)::INT AS in_events, max(b)::INT AS in_customers FROM (
  SELECT user_id AS id, 1 AS a, 0 AS b FROM events UNION ALL SELECT c_custkey, 0, 1 FROM customer) GROUP BY id""")
def _(t):
    legs = t.events.select(F.col("user_id").alias("id"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        t.customer.select(F.col("c_custkey").alias("id"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    return legs.groupBy("id").agg(F.max("a").alias("in_events"), F.max("b").alias("in_customers"))


@query("u3_dedupe_hits", """SELECT source, n_lines, doc_id FROM (SELECT source, n_lines, doc_id,
  row_number() OVER (PARTITION BY source, n_lines ORDER BY n_chars DESC, doc_id) AS o
  FROM (SELECT *, length(text) - length(replace(text, chr(10), '')) AS n_lines FROM documents)) WHERE o = 1""")
def _(t):
    from mnemospark.functions.text import newline_count
    lines = t.documents.withColumn("n_lines", newline_count("text").cast("bigint"))
    return first_per_key(lines, ["source", "n_lines"], [F.desc("n_chars"), F.asc("doc_id")]).select("source", "n_lines", "doc_id")


@query("c2_chunk_chars", f"""SELECT doc_id, w::INT AS chunk_index, (w * 300)::INT AS char_start, substr(text, (w * 300 + 1)::BIGINT, 400) AS content
FROM (SELECT doc_id, text, unnest(range({_windows('length(text)', 400, 300)})) AS w FROM documents)""")
def _(t):
    return chunking.chunk_chars(t.documents.select("doc_id", "text"), 400, 100)

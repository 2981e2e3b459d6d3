"""One registered query for each operator: the whole table, production parameters, the whole result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from mnemospark.llm import alignment, bpe, lexical, license_scan, mixing, multi_index, near_dedup, pii, quality, repeats, toxicity, url_filter, warc

QUERIES, ORACLES = {}, {}
TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    """Register a function of the session and the folder; ``sql`` is the same result in DuckDB."""
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_bpe")
def op1(spark, folder):
    path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query("op10_quality")
def op10(spark, folder):
    return quality.judge(table(spark, folder, "documents")).drop("d2")


@query("op5_mixing")
def op5(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).drop("places")


@query("op9_pii")
def op9(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    joined = lambda col: F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op3_near_dedup")
def op3(spark, folder):
    return near_dedup.near_classes(table(spark, folder, "documents"))


@query("op4_url_filter")
def op4(spark, folder):
    return url_filter.judge(table(spark, folder, "pages"))


@query("op7_multi_index")
def op7(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return multi_index.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query("op8_toxicity")
def op8(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.judge(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query("op2_repeats")
def op2(spark, folder):
    return repeats.repeated_passages(table(spark, folder, "documents"))


OP6_SQL = r"""
WITH pages_ AS (SELECT page_id, url, html, '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || (page_id // 100)::VARCHAR AS day,
  CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://'
    || regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), CASE WHEN url ILIKE 'http://%' THEN ':80$' WHEN url ILIKE 'https://%' THEN ':443$' ELSE 'x^' END, '')
    || CASE WHEN starts_with(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1), '/') THEN '' ELSE '/' END
    || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) ELSE url END AS key FROM pages),
responses AS (SELECT page_id * 2 AS id, key, page_id * 10 AS at, CASE WHEN page_id % 3 <> 0 THEN tag END AS etag, day, html FROM pages_ WHERE page_id % 11 <> 0),
revisits AS (SELECT page_id * 2 + 1 AS id, key, page_id * 10 + 75 AS at, CASE WHEN page_id % 5 = 0 THEN '"other"' WHEN page_id % 3 <> 0 THEN tag END AS etag, day FROM pages_),
paired AS (SELECT v.id, v.etag, v.day, r.id AS rid, r.etag AS retag, r.day AS rday, r.html,
  row_number() OVER (PARTITION BY v.id ORDER BY r.at DESC, r.id DESC) AS n FROM revisits v LEFT JOIN responses r ON r.key = v.key AND r.at <= v.at),
judged AS (SELECT *, rid IS NOT NULL AND CASE WHEN etag IS NOT NULL AND retag IS NOT NULL THEN etag = retag ELSE day = rday END AS ok FROM paired WHERE n = 1)
SELECT id AS record_id, rid AS refers_to, ok AS resolved, CASE WHEN ok THEN sha256(html) END AS body_sha256,
  CASE WHEN ok THEN 'content-type=text/html,date=later,expires=never,server=a' ELSE 'Date=later,Expires=never,Server=b' END AS headers FROM judged"""


@query("op6_warc_revisits", OP6_SQL)
def op6(spark, folder):
    resolved = warc.resolve(warc.crawl_of(table(spark, folder, "pages")))
    headers = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return resolved.select("record_id", "refers_to", "resolved", F.sha2("body", 256).alias("body_sha256"), headers.alias("headers"))


@query("op13_license_scan", license_scan.sql())
def op13(spark, folder):
    found = license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("long"))
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        F.array_join(license_scan.labels_of(base), ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


@query("op12_lexical_search", lexical.SQL)
def op12(spark, folder):
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_alignment")
def op11(spark, folder):
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.align(table(spark, folder, "documents"), a, b).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", groups.alias("groups_sha256"))

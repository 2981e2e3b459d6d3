"""Registered queries: chunking, synchronisation, path search and object events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mnemospark.operators import chunking, listing, trigrams
from mnemospark.plans import fragments as fr
from mnemospark.plans.registry import query
from mnemospark.plans.sync import CHUNK_SCHEMA, chunk_objects, sync
from mnemospark.session import durable, ensure_checkpoint_dir
from mnemospark.streaming import events

_PIECES = r"regexp_extract_all(text, '\s*\S+\s*\z|\s*\S+|\A\s+\z')"


def _windows(n: str, limit: int, step: int) -> str:
    return f"CASE WHEN {n} <= 0 THEN 0 WHEN {n} <= {limit} THEN 1 ELSE (ceil(({n} - {limit}) / {step}::DOUBLE))::BIGINT + 1 END"


def _token_chunks(source: str, limit: int, overlap: int, keep: str) -> str:
    """``SELECT keep, w, char_start, char_end, line_start, content`` over ``source(keep, text)``."""
    step = limit - overlap
    return f"""SELECT {keep}, w, length(head)::INT AS char_start, (length(head) + length(content))::INT AS char_end,
      (length(head) - length(replace(head, chr(10), '')))::INT AS line_start, content
    FROM (SELECT {keep}, w, array_to_string(ps[1:(w * {step})::BIGINT], '') AS head,
                 array_to_string(ps[(w * {step} + 1)::BIGINT:(w * {step} + {limit})::BIGINT], '') AS content
          FROM (SELECT {keep}, ps, unnest(range({_windows('len(ps)', limit, step)})) AS w
                FROM (SELECT {keep}, {_PIECES} AS ps FROM {source})))"""


@query("c1_chunk_tokens", f"""SELECT doc_id, w::INT AS chunk_index, char_start, char_end, line_start, content
FROM ({_token_chunks('documents', 100, 20, 'doc_id')})""")
def _(t):
    return chunking.chunk_tokens(t.spread("documents", "doc_id", "text"), 100, 20, key="doc_id").drop("page_number")


@query("w4_chunk_index_across_pages", f"""SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, w) - 1)::INT AS chunk_index,
  turn AS page_number, char_start, line_start, content FROM ({_token_chunks('conversations', 16, 4, 'conv_id, turn')})""")
def _(t):
    return (chunking.chunk_tokens(t.conversations, 16, 4, key="conv_id", page_col="turn")
            .select("conv_id", "chunk_index", "page_number", "char_start", "line_start", "content"))


# ---- listings -----------------------------------------------------------------------------

_STORED = f"""stored AS (
  SELECT {fr.OBJECT_PATH} AS path, md5(CASE WHEN toxic = 1 THEN text || 'x' ELSE text END) AS etag FROM documents JOIN labels USING (doc_id)
  UNION ALL SELECT 'old/' || item_id || '.txt', md5(text) FROM benchmark),
listing AS (SELECT {fr.OBJECT_PATH} AS path, md5(text) AS etag, octet_length(encode(text)) AS length, text FROM documents),
diff AS (SELECT coalesce(l.path, s.path) AS path, l.etag, s.etag AS stored_etag, l.length,
  CASE WHEN l.path IS NULL THEN 'deleted' WHEN s.etag IS NULL THEN 'created' WHEN l.etag <> s.etag THEN 'updated' ELSE 'unchanged' END AS change
  FROM listing l FULL OUTER JOIN stored s ON l.path = s.path)"""


def stored_chunks(t):
    """An earlier chunk table: one chunk per labelled document, changed where toxic, plus vanished files."""
    labelled = t.documents.join(t.labels, "doc_id").select(
        fr.object_path().alias("source_path"), F.when(F.col("toxic") == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("content"))
    gone = t.benchmark.select(F.concat(F.lit("old/"), F.col("item_id"), F.lit(".txt")).alias("source_path"), F.col("text").alias("content"))
    rows = labelled.unionByName(gone).withColumn("etag", F.md5("content"))
    fields = t.spark.createDataFrame([], CHUNK_SCHEMA).schema
    fixed = {"chunk_index": F.lit(0), "line_start": F.lit(0)}
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else
                          fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)) for f in fields])


@query("c3_diff_listing", f"WITH {_STORED} SELECT path, etag, stored_etag, change FROM diff")
def _(t):
    stored = stored_chunks(t).select(F.col("source_path").alias("path"), "etag")
    return listing.diff_listing(fr.objects(t), stored)


@query("j5_listing_diff", f"WITH {_STORED} SELECT change, count(*) AS n FROM diff GROUP BY change")
def _(t):
    stored = stored_chunks(t).select(F.col("source_path").alias("path"), "etag")
    return listing.diff_listing(fr.objects(t), stored).groupBy("change").agg(F.count("*").alias("n"))


_FRESH = f"""fresh AS (SELECT path, w, content FROM ({_token_chunks("(SELECT l.path, l.text FROM listing l JOIN diff USING (path) WHERE change IN ('created', 'updated') AND l.length <= 20000)", 100, 20, 'path')}))"""


@query("c4_sync_report", f"""WITH {_STORED}, {_FRESH}
SELECT count(etag) AS seen, sum((change = 'unchanged')::INT)::BIGINT AS skipped,
  sum((change IN ('created', 'updated') AND length > 20000)::INT)::BIGINT AS failed,
  sum((change IN ('created', 'updated') AND length <= 20000)::INT)::BIGINT AS files_processed,
  (SELECT count(*) FROM fresh) AS chunks_written FROM diff""")
def _(t):
    return sync(fr.objects(t), stored_chunks(t), limit=100, overlap=20, max_bytes=20000).report


@query("c4_sync_chunks", f"""WITH {_STORED}, {_FRESH}
SELECT path AS source_path, w::INT AS chunk_index, md5(content) AS content_md5 FROM fresh
UNION ALL SELECT path, 0, etag FROM stored WHERE path IN (SELECT path FROM diff WHERE change = 'unchanged')""")
def _(t):
    done = sync(fr.objects(t), stored_chunks(t), limit=100, overlap=20, max_bytes=20000)
    return done.chunks.select("source_path", "chunk_index", F.md5("content").alias("content_md5"))


_P = f"(SELECT page_id, {fr.URL_PATH} AS p FROM pages)"


@query("c5_ls", f"""SELECT s || CASE WHEN d THEN '/' ELSE '' END AS path, d AS is_dir FROM (
  SELECT string_split(p, '/')[1] AS s, bool_or(contains(p, '/')) AS d FROM {_P} GROUP BY 1)""")
def _(t):
    return listing.ls(fr.url_paths(t))


@query("c5_ls_folder", f"""SELECT 'src1/' || s || CASE WHEN d THEN '/' ELSE '' END AS path, d AS is_dir FROM (
  SELECT string_split(substr(p, 6), '/')[1] AS s, bool_or(contains(substr(p, 6), '/')) AS d
  FROM (SELECT {fr.OBJECT_PATH} AS p FROM documents) WHERE starts_with(p, 'src1/') GROUP BY 1)""")
def _(t):
    return listing.ls(fr.objects(t), "src1", path_col="path")


@query("c6_glob", f"""SELECT DISTINCT p AS path FROM (SELECT {fr.OBJECT_PATH} AS p FROM documents)
WHERE regexp_matches(p, '^src[12][^/]*/(en|fr)/[^/]*7\\.txt$')""")
def _(t):
    return listing.glob(fr.objects(t), "src[12]*/{en,fr}/*7.txt", path_col="path")


@query("c6_glob_below", f"""SELECT DISTINCT p AS path FROM (SELECT {fr.OBJECT_PATH} AS p FROM documents)
WHERE regexp_matches(p, '^src3/([^/]+/)*[0-9]?[0-9][^/]\\.txt$')""")
def _(t):
    return listing.glob(fr.objects(t), "**/{?,??,???}.txt", "src3/", path_col="path").filter(
        ~F.element_at(F.split("path", "/"), -1).rlike(r"^.\.txt$"))


_CHUNKS = f"""ck AS (SELECT path || '#' || w AS id, path AS source_path, w, line_start, content
  FROM ({_token_chunks(f"(SELECT {fr.OBJECT_PATH} AS path, text FROM documents)", 100, 20, 'path')}))"""


def chunk_table(t, vectors: bool):
    """Chunks of all documents; with vectors as a written table, which a search reads several times."""
    ids = F.concat_ws("#", "source_path", F.col("chunk_index").cast("string"))
    if vectors:
        made = chunk_objects(fr.objects(t), limit=100, overlap=20)
        return durable(made.withColumn("id", ids))
    texts = t.spread("documents", "doc_id", "source", "lang", "text")
    cut = chunking.chunk_tokens(texts.select(fr.object_path().alias("source_path"), "text"), 100, 20)
    return cut.withColumn("id", ids)


@query("c7_grep_literal", f"""WITH {_CHUNKS} SELECT source_path, line_start, content FROM (
  SELECT *, row_number() OVER (PARTITION BY source_path, line_start ORDER BY w) AS o FROM ck
  WHERE contains(lower(content), 'and the') AND regexp_matches(source_path, '/[^/]*[0-4]\\.txt$')) WHERE o = 1""")
def _(t):
    return listing.grep_literal(chunk_table(t, False), "And The", glob_pattern="*[0-4].txt")


def _grep_index(t):
    """The chunks of all documents with a trigram index, in the shared folder."""
    return trigrams.build_trigram_index(chunk_table(t, False), f"{ensure_checkpoint_dir(t.spark)}/trigrams-{uuid.uuid4().hex}")


@query("c7_grep_indexed", f"""WITH {_CHUNKS} SELECT source_path, line_start, content FROM (
  SELECT *, row_number() OVER (PARTITION BY source_path, line_start ORDER BY w) AS o FROM ck
  WHERE contains(lower(content), 'worthless')) WHERE o = 1""")
def _(t):
    return trigrams.grep_indexed(_grep_index(t), "Worthless")


@query("c7_grep_regex", f"""WITH {_CHUNKS} SELECT source_path, line_start, content FROM (
  SELECT *, row_number() OVER (PARTITION BY source_path, line_start ORDER BY w) AS o FROM ck
  WHERE regexp_matches(content, 'under (the|CC) [A-Z]+[- ][A-Za-z]+')) WHERE o = 1""")
def _(t):
    return trigrams.grep_indexed(_grep_index(t), "under (the|CC) [A-Z]+[- ][A-Za-z]+", glob_pattern="*", regex=True)


@query("c8_grep_hybrid", f"""WITH {_CHUNKS},
gq AS (SELECT item_id AS query_id, text, {fr.hashed('text')} AS vector FROM benchmark),
d AS (SELECT id, 'content' AS field, content AS text FROM ck), {fr.bm25('gq', 'd')},
tl AS ({fr.ranked('(SELECT bm.* FROM bm JOIN ck USING (id) WHERE starts_with(source_path, ' + chr(39) + 'src1/' + chr(39) + '))')}),
cv AS (SELECT id, source_path, {fr.hashed('content')} AS v FROM ck),
vs AS (SELECT query_id, id, source_path, {fr.cos_score('vector', 'v')} AS score FROM gq, cv),
v0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS o FROM vs
       WHERE starts_with(source_path, 'src1/')) WHERE o <= 40),
vl AS ({fr.ranked('v0')}),
u AS (SELECT query_id, id, 0.5::DOUBLE / (rank + 60) AS s FROM tl UNION ALL SELECT query_id, id, 0.5::DOUBLE / (rank + 60) FROM vl),
fu AS (SELECT query_id, id, round(sum(s), 6) AS score FROM u GROUP BY query_id, id),
fr AS ({fr.ranked('fu')}),
once AS (SELECT * FROM (SELECT fr.*, source_path, line_start, content, row_number() OVER (PARTITION BY query_id, source_path, line_start ORDER BY rank) AS o
         FROM fr JOIN ck USING (id)) WHERE o = 1)
SELECT * FROM (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY rank))::INT AS rank, source_path, line_start, content, score FROM once) WHERE rank <= 20""")
def _(t):
    from mnemospark.operators.embedding import hashed_embedding
    asked = fr.text_queries(t).withColumn("vector", hashed_embedding("text", 64))
    return listing.grep_hybrid(asked, chunk_table(t, True), "src1/", limit=20)


# ---- object events ------------------------------------------------------------------------

def _event_bodies(t):
    """Notifications about the documents: created, removed, wrapped, unknown and broken ones."""
    name = F.element_at(F.array(F.lit("ObjectCreated:Put"), F.lit("ObjectRemoved:Delete"), F.lit("ObjectTagging:Put")), (F.col("doc_id") % 3 + 1).cast("int"))
    record = F.to_json(F.struct(F.array(F.struct(
        name.alias("eventName"), F.struct(F.struct(fr.object_path().alias("key")).alias("object")).alias("s3"))).alias("Records")))
    body = (F.when(F.col("doc_id") % 7 == 0, F.lit("{broken")).when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(record.alias("Message"))))
            .otherwise(record))
    return t.documents.select(F.col("doc_id").alias("seq"), body.alias("body"))


_ACTIONS = f"""ev AS (SELECT doc_id AS seq, CASE WHEN doc_id % 7 = 0 THEN 'malformed' WHEN NOT starts_with({fr.OBJECT_PATH}, 'src1') THEN 'ignored'
  WHEN doc_id % 3 = 0 THEN 'upsert' WHEN doc_id % 3 = 1 THEN 'delete' ELSE 'ignored' END AS action,
  CASE WHEN doc_id % 7 <> 0 THEN {fr.OBJECT_PATH} END AS path FROM documents)"""


@query("r2_object_events", f"WITH {_ACTIONS} SELECT seq, action, path FROM ev")
def _(t):
    return events.parse_object_events(_event_bodies(t), "src1", keep=("seq",))


@query("r3_idempotent_ingest", f"""WITH {_STORED}, {_ACTIONS},
changed AS (SELECT l.path, l.text FROM listing l JOIN ev USING (path) WHERE action = 'upsert'
  AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.path = l.path AND s.etag = l.etag)),
fresh AS (SELECT path, w, content FROM ({_token_chunks('changed', 100, 20, 'path')}))
SELECT path AS source_path, w::INT AS chunk_index, md5(content) AS content_md5 FROM fresh
UNION ALL SELECT path, 0, etag FROM stored WHERE path NOT IN (SELECT path FROM changed)
  AND path NOT IN (SELECT path FROM ev WHERE action = 'delete')""")
def _(t):
    parsed = events.parse_object_events(_event_bodies(t), "src1", keep=("seq",))
    once = events.apply_events(stored_chunks(t), parsed, fr.objects(t), limit=100, overlap=20)
    return once.select("source_path", "chunk_index", F.md5("content").alias("content_md5"))

"""Registered queries: sources, filters, joins, aggregates, limits and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mnemospark.functions import filters, paths, text, values
from mnemospark.operators import checkpoints, store, tables
from mnemospark.operators.ranking import first_per_key
from mnemospark.plans import fragments as fr
from mnemospark.plans.registry import query
from mnemospark.session import ensure_checkpoint_dir
from mnemospark.sources import documents, objects

# ---- sources ------------------------------------------------------------------------------


@query("s1_load_documents", """SELECT o_orderkey, o_orderstatus || ' ' || o_orderpriority AS page_content,
  CAST(o_custkey AS VARCHAR) AS o_custkey_text, 'shop' AS "database", 'orders' AS "collection"
FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IN ('F', 'P')""")
def _(t):
    loaded = documents.load_documents(
        t.orders, filter={"$and": [{"o_totalprice": {"$gt": 100000}}, {"o_orderstatus": {"$in": ["F", "P"]}}]},
        field_names=["o_orderstatus", "o_orderpriority"], metadata_names=["o_custkey"],
        source_cols={"database": "shop", "collection": "orders"}, keep=["o_orderkey"])
    return loaded.withColumnRenamed("o_custkey", "o_custkey_text")


@query("s2_scan_objects", """SELECT 'source=' || source || '/lang=' || lang AS folder, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes
FROM documents GROUP BY source, lang""")
def _(t):
    """Documents written as text files by source and language, then listed; a line break ends each."""
    root = f"{ensure_checkpoint_dir(t.spark)}/files-{uuid.uuid4().hex}"
    t.documents.select("source", "lang", "text").write.partitionBy("source", "lang").text(root)
    listed = objects.scan_objects(t.spark, root, with_content=False)
    return listed.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.sum("length").alias("bytes"))


@query("s3_read_lines", r"""WITH l AS (SELECT doc_id, string_split(replace(regexp_replace(text, '\r?\n\z', ''), chr(13) || chr(10), chr(10)), chr(10)) AS ls
  FROM documents WHERE text <> '')
SELECT doc_id, (i - 1)::INT AS line, ls[i] AS content FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)
WHERE i - 1 >= 1 AND i - 1 < 4""")
def _(t):
    return objects.read_lines(t.documents, 1, 3, key="doc_id")


@query("s4_bulk_replace_text", """SELECT doc_id, 'all' AS mode, replace(text, 'the', 'THE') AS text,
  (length(text) - length(replace(text, 'the', ''))) // 3 AS replaced FROM documents
UNION ALL SELECT doc_id, 'first', CASE WHEN strpos(text, 'the') = 0 THEN text ELSE
  substr(text, 1, strpos(text, 'the') - 1) || 'THE' || substr(text, strpos(text, 'the') + 3) END,
  least((length(text) - length(replace(text, 'the', ''))) // 3, 1) FROM documents""")
def _(t):
    src = t.documents.select("doc_id", "text")
    return objects.bulk_replace_text(src, "the", "THE", True).withColumn("mode", F.lit("all")).unionByName(
        objects.bulk_replace_text(src, "the", "THE", False).withColumn("mode", F.lit("first")))


@query("s5_read_objects", f"""SELECT pos, path, md5(CASE WHEN error IS NULL THEN text END) AS content_md5, error FROM (
  SELECT a.pos, a.path, d.text, CASE WHEN d.doc_id IS NULL THEN 'file_not_found'
    WHEN octet_length(encode(d.text)) > 8000 THEN 'too_large' END AS error
  FROM (SELECT doc_id AS pos, {fr.OBJECT_PATH} AS path FROM documents
        UNION ALL SELECT -1 - item_id, 'bench/' || item_id FROM benchmark) a
  LEFT JOIN documents d ON a.path = d.source || '/' || d.lang || '/' || d.doc_id || '.txt')""")
def _(t):
    asked = t.documents.select(F.col("doc_id").alias("pos"), fr.object_path().alias("path")).unionByName(
        t.benchmark.select((-1 - F.col("item_id")).alias("pos"), F.concat(F.lit("bench/"), F.col("item_id")).alias("path")))
    read = objects.read_objects(asked, fr.objects(t), 8000)
    return read.select("pos", "path", F.md5("content").alias("content_md5"), "error")


@query("s6_add_texts", f"""WITH e AS (SELECT sha256(concat_ws(chr(1), role, text)) AS id, role, {fr.hashed('text')} AS v FROM conversations)
SELECT id, role, round(list_sum(v), 6) AS total, round(list_max(v), 6) AS peak FROM e""")
def _(t):
    from mnemospark.operators.embedding import add_texts
    added = add_texts(t.conversations.select("role", "text"), dims=64)
    return added.select("id", "role", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
                        F.round(F.array_max("embedding"), 6).alias("peak"))


@query("s7_get_by_ids", "SELECT * FROM documents WHERE doc_id IN (SELECT item_id * 7 FROM benchmark)")
def _(t):
    ids = t.benchmark.select((F.col("item_id") * 7).alias("id"))
    return tables.get_by_ids(t.documents, ids.unionByName(ids), "doc_id")


@query("s8_delete_ids", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(t):
    return tables.delete_ids(t.documents.select("doc_id", "lang"), t.labels.filter("toxic = 1").select("doc_id"), "doc_id")


@query("s9_upsert", """WITH up AS (SELECT user_id AS c_custkey, arg_max(event_type, event_id) AS c_mktsegment, arg_min(value, event_id) AS c_acctbal
  FROM events GROUP BY user_id)
SELECT coalesce(c.c_custkey, up.c_custkey) AS c_custkey, coalesce(up.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
  CASE WHEN c.c_custkey IS NULL THEN up.c_acctbal ELSE c.c_acctbal END AS c_acctbal
FROM (SELECT c_custkey * 2 AS c_custkey, c_mktsegment, c_acctbal FROM customer) c FULL OUTER JOIN up ON c.c_custkey = up.c_custkey""")
def _(t):
    base = t.customer.select((F.col("c_custkey") * 2).alias("c_custkey"), "c_mktsegment", "c_acctbal")  # every other user is new
    updates = t.events.select(F.col("user_id").alias("c_custkey"), F.col("event_type").alias("c_mktsegment"),
                              F.col("value").alias("c_acctbal"), "event_id")
    return tables.upsert(base, updates, ["c_custkey"], ["c_mktsegment"], ["c_acctbal"], seq="event_id")


@query("s10_profile_table", """SELECT 'doc_id' AS field, 'bigint' AS type, count(*) AS rows, count(d.doc_id) AS non_null FROM documents d LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'text', 'string', count(*), count(text) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'grade.quality', 'int', count(*), count(quality) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'grade.toxic', 'int', count(*), count(toxic) FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    nested = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "text", F.struct("quality", "toxic").alias("grade"))
    return documents.profile_table(nested)


@query("s10_elide", """SELECT doc_id, CASE WHEN length(text) > 20 THEN substr(text, 1, 21) ELSE text END AS text, lang,
  CASE WHEN length(source || text) > 20 THEN substr(source || text, 1, 21) ELSE source || text END AS nested FROM documents""")
def _(t):
    shaped = t.documents.select("doc_id", "text", "lang", F.struct(F.concat("source", "text").alias("s")).alias("n"))
    return documents.elide(shaped).select("doc_id", "text", "lang", F.col("n.s").alias("nested"))


@query("s13_to_json_rows", """SELECT o_orderkey, '{"o_orderkey":"' || o_orderkey || '","o_orderstatus":"' || o_orderstatus
  || '","o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS json FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return documents.to_json_rows(rows, ["o_orderkey"], keep=["o_orderkey"])


@query("s14_text_from_objects", """SELECT path, text FROM (SELECT *, 'f/' || doc_id || CASE doc_id % 4 WHEN 0 THEN '.txt' WHEN 1 THEN '.MD'
  WHEN 2 THEN '.pdf' ELSE '.weird' END AS path FROM documents) WHERE doc_id % 4 <> 2""")
def _(t):
    suffix = F.element_at(F.array(F.lit(".txt"), F.lit(".MD"), F.lit(".pdf"), F.lit(".weird")), (F.col("doc_id") % 4 + 1).cast("int"))
    files = t.documents.select(F.concat(F.lit("f/"), F.col("doc_id"), suffix).alias("path"), F.col("text").cast("binary").alias("content"))
    return objects.text_from_objects(files).select("path", "text")


# ---- filters ------------------------------------------------------------------------------

@query("p1_filter", """SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
WHERE ((quality <> 0 OR quality IS NULL) AND lang IN ('en', 'fr') AND (n_chars >= 1000 OR source = 'src1')
  AND (toxic NOT IN (1) OR toxic IS NULL))""")
def _(t):
    spec = {"$and": [{"quality": {"$ne": 0}}, {"lang": {"$in": ["en", "fr"]}},
                     {"$or": [{"n_chars": {"$gte": 1000}}, {"source": {"$eq": "src1"}}]}, {"toxic": {"$nin": 1}}]}
    joined = t.documents.join(t.labels, "doc_id", "left")
    return joined.filter(filters.filter_to_column(spec)).select("doc_id", "quality", "toxic")


@query("p2_iso_dates", """SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20 12:30:00'
UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate IN (TIMESTAMP '1997-05-28', TIMESTAMP '1998-10-03')""")
def _(t):
    window = {"$and": [{"ts": {"$gte": {"date": "2024-01-10", "type": "date"}}},
                       {"ts": {"$lt": {"datetime": "2024-01-20T12:30:00Z", "type": "datetime"}}}]}
    days = {"o_orderdate": {"$in": [{"date": "1997-05-28", "type": "date"}, {"date": "1998-10-03", "type": "date"}]}}
    return t.events.filter(filters.filter_to_column(window)).select("event_id", "ts").unionByName(
        t.orders.filter(filters.filter_to_column(days)).select(F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("ts")))


@query("p4_nested_equality", """SELECT event_id, event_type FROM events
WHERE CAST(json_extract(props, '$.k') AS DOUBLE) = 50 AND event_type = 'click'""")
def _(t):
    wrapped = t.events.withColumn("value", F.parse_json(F.concat(
        F.lit('{"type":"'), F.col("event_type"), F.lit('","props":'), F.col("props"), F.lit("}"))))
    return wrapped.filter(filters.value_equals("value", {"props.k": 50, "type": "click", "props": {"k": 50}})).select("event_id", "event_type")


@query("p7_prefix_and_literal", f"""SELECT page_id FROM pages WHERE starts_with(url, 'https://') AND contains(lower(html), 'article><h1>the')
UNION ALL SELECT doc_id FROM documents WHERE contains(lower(text), 'and the')""")
def _(t):
    return t.pages.filter(paths.under("url", "https://") & text.contains_ignore_case("html", "ARTICLE><H1>The")).select("page_id").unionByName(
        t.documents.filter(text.contains_ignore_case("text", "And THE")).select(F.col("doc_id").alias("page_id")))


@query("p9_namespace_ok", """SELECT page_id, len(list_filter(string_split(url, '/'), lambda x: x = '' OR contains(x, '.'))) = 0 AS raw_ok,
  len(list_filter(string_split(regexp_replace(url, '^https?://', ''), '/'), lambda x: x = '' OR contains(x, '?'))) = 0 AS path_ok FROM pages""")
def _(t):
    bare = F.split(F.regexp_replace("url", "^https?://", ""), "/")
    return t.pages.select("page_id", store.namespace_ok(F.split("url", "/"), ".").alias("raw_ok"), store.namespace_ok(bare, "?").alias("path_ok"))


@query("p10_size_guard", """SELECT 'kept' AS part, count(*) AS n, sum(octet_length(encode(text)))::BIGINT AS bytes FROM documents WHERE octet_length(encode(text)) <= 3000
UNION ALL SELECT 'failed', count(*), sum(octet_length(encode(text)))::BIGINT FROM documents WHERE octet_length(encode(text)) > 3000""")
def _(t):
    kept, failed = objects.within_size(fr.objects(t), 3000)
    return kept.agg(F.lit("kept").alias("part"), F.count("*").alias("n"), F.sum("length").alias("bytes")).unionByName(
        failed.agg(F.lit("failed").alias("part"), F.count("*").alias("n"), F.sum("length").alias("bytes")))


# ---- joins --------------------------------------------------------------------------------

@query("j1_lookup_unwind", "SELECT l.l_orderkey, l.l_linenumber, o.o_orderpriority FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'")
def _(t):
    inner = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return t.lineitem.select("l_orderkey", "l_linenumber").join(inner, "l_orderkey")


@query("j2_semi_anti", """SELECT o_orderkey, 'semi' AS side FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
UNION ALL SELECT o_orderkey, 'anti' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    keys = t.orders.select("o_orderkey")
    return keys.join(returned, "o_orderkey", "left_semi").withColumn("side", F.lit("semi")).unionByName(
        keys.join(returned, "o_orderkey", "left_anti").withColumn("side", F.lit("anti")))


@query("j3_ordered_lookup", """SELECT event_id, pos::INT AS pos, key, c_name, c_custkey IS NOT NULL AS found FROM (
  SELECT event_id, unnest([0, 1]) AS pos, unnest([user_id, user_id + 1400]) AS key FROM events) LEFT JOIN customer ON key = c_custkey""")
def _(t):
    asked = tables.asked_keys(t.events.select("event_id", F.array(F.col("user_id"), F.col("user_id") + 1400).alias("keys")), "keys")
    names = t.customer.select(F.col("c_custkey").alias("key"), "c_name")
    return tables.lookup_in_order(asked, names, "key")


@query("j4_pending_writes", """SELECT CAST(c_custkey AS VARCHAR) AS thread_id, c_name, CAST(o_orderkey AS VARCHAR) AS task_id, o_orderstatus AS channel, o_orderpriority AS write_value
FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def _(t):
    """Customers as checkpoints, their orders as pending writes."""
    where = [F.lit("").alias("checkpoint_ns"), F.lit("1").alias("checkpoint_id")]
    saved = t.customer.select(F.col("c_custkey").cast("string").alias("thread_id"), *where, "c_name")
    writes = t.orders.select(F.col("o_custkey").cast("string").alias("thread_id"), *where, F.col("o_orderkey").cast("string").alias("task_id"),
                             F.lit(0).alias("idx"), F.col("o_orderstatus").alias("channel"), F.col("o_orderpriority").alias("value"))
    return checkpoints.with_writes(saved, writes).select("thread_id", "c_name", "task_id", "channel", "write_value")


# ---- aggregates ---------------------------------------------------------------------------

@query("a1_group_first", """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1""")
def _(t):
    return first_per_key(t.orders, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderdate")


@query("a2_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return t.events.select("user_id", "event_type").distinct()


@query("a3_set_union", """SELECT DISTINCT user_id AS id, key, value FROM (
  SELECT user_id, unnest(['type', 'day']) AS key, unnest([event_type, strftime(ts, '%Y-%m-%d')]) AS value FROM events)""")
def _(t):
    pairs = F.map_from_arrays(F.array(F.lit("type"), F.lit("day")), F.array(F.col("event_type"), F.date_format("ts", "yyyy-MM-dd")))
    return t.events.select(F.col("user_id").alias("id"), F.explode(pairs).alias("key", "value")).distinct()


@query("a4_push_in_order", """WITH pushed AS (SELECT user_id AS src, event_id AS seq, unnest([0, 1]) AS pos, unnest([event_type, CAST(event_id AS VARCHAR)]) AS dst FROM events)
SELECT c_custkey AS src, 0::BIGINT AS at, c_name AS dst FROM customer
UNION ALL SELECT src, row_number() OVER (PARTITION BY src ORDER BY seq, pos) - 1 + (SELECT count(*) FROM customer WHERE c_custkey = src) AS at, dst FROM pushed""")
def _(t):
    base = t.customer.select(F.col("c_custkey").alias("src"), F.lit(0).cast("bigint").alias("at"), F.col("c_name").alias("dst"))
    pushed = t.events.select(F.col("user_id").alias("src"), F.col("event_id").alias("seq"),
                             F.posexplode(F.array(F.col("event_type"), F.col("event_id").cast("string"))).alias("pos", "dst"))
    return tables.push_in_order(base, pushed, ["src"], [F.asc("seq"), F.asc("pos")])


@query("a5_count_sum", """SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def _(t):
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment")
            .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


@query("a6_report", """SELECT count(*) AS seen, sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END)::BIGINT AS processed,
  sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END)::BIGINT AS skipped, sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END)::BIGINT AS failed
FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    joined = t.documents.join(t.labels, "doc_id", "left")
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    return joined.agg(F.count("*").alias("seen"), count(F.col("quality").isNull()).alias("processed"),
                      count(F.col("quality") == 1).alias("skipped"), count(F.col("quality") == 0).alias("failed"))


# ---- limits -------------------------------------------------------------------------------

@query("l1_sort_limit", "SELECT url FROM pages ORDER BY url LIMIT 200")
def _(t):
    return t.pages.select("url").orderBy("url").limit(200)


@query("l2_newest_first", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 50")
def _(t):
    return t.events.select("event_id", "ts").orderBy(F.desc("ts"), "event_id").limit(50)


@query("l3_keyed_limit", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 100")
def _(t):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").limit(100)


@query("l4_skip", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30 OFFSET 20")
def _(t):
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(20).limit(30).select("o_orderkey")


# ---- scalar functions ---------------------------------------------------------------------

@query("f1_segments", f"""SELECT page_id, string_split({fr.URL_PATH}, '/')[1] AS host, substr(url, 5) AS rest FROM pages""")
def _(t):
    return fr.url_paths(t).join(t.pages, "page_id").select("page_id", paths.first_segment("source_path").alias("host"), paths.relative("url", "http").alias("rest"))


@query("f2_arrays", f"""SELECT page_id, array_to_string(p[1:2], '|') AS head, p[2] AS second, len(p)::INT AS n, array_to_string(list_concat(p, [page_id::VARCHAR]), '|') AS whole
FROM (SELECT page_id, string_split({fr.URL_PATH}, '/') AS p FROM pages)""")
def _(t):
    p = F.split("source_path", "/")
    return fr.url_paths(t).select("page_id", F.array_join(F.slice(p, 1, 2), "|").alias("head"), F.try_element_at(p, F.lit(2)).alias("second"),
                                  F.size(p).alias("n"), F.array_join(F.concat(p, F.array(F.col("page_id").cast("string"))), "|").alias("whole"))


@query("f3_path_parents", f"""SELECT page_id, i::INT AS depth, array_to_string(p[1:i + 1], '/') AS parent
FROM (SELECT page_id, p, unnest(range(len(p))) AS i FROM (SELECT page_id, string_split({fr.URL_PATH}, '/') AS p FROM pages))""")
def _(t):
    return fr.url_paths(t).select("page_id", F.posexplode(paths.parents(F.split("source_path", "/"))).alias("depth", "parent"))


@query("f4_matches", r"""SELECT doc_id, regexp_matches(text, 'th[ae]n? +re') AS by_regex, contains(lower(text), 'the.') AS by_literal FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.col("text").rlike("th[ae]n? +re").alias("by_regex"), text.contains_ignore_case("text", "THE.").alias("by_literal"))


@query("f5_glob_regex", rf"""SELECT page_id, regexp_matches(p, '^(www|m)\.[^/]*/[a-e][^/]*/[^/]*$') AS narrow, regexp_matches(p, '^([^./][^/]*/)*[^./][^/]*\.html$') AS html
FROM (SELECT page_id, {fr.URL_PATH} AS p FROM pages)""")
def _(t):
    return fr.url_paths(t).select("page_id", paths.matches_glob("source_path", "{www,m}.*/[a-e]*/*", dotfiles=True).alias("narrow"),
                                  paths.matches_glob("source_path", "**/*.html").alias("html"))


@query("f6_line_at", """SELECT doc_id, length(head) - length(replace(head, chr(10), '')) AS line
FROM (SELECT doc_id, substr(text, 1, length(text) // 2) AS head FROM documents)""")
def _(t):
    return t.documents.select("doc_id", text.line_at("text", F.floor(F.length("text") / 2).cast("int")).cast("bigint").alias("line"))


@query("f7_basename", f"SELECT page_id, string_split({fr.URL_PATH}, '/')[-1] AS name FROM pages")
def _(t):
    return fr.url_paths(t).select("page_id", paths.basename("source_path").alias("name"))


@query("f8_typed_map", """SELECT event_id, '{"type":"json","value":"' || event_type || '"}' AS kind, '{"type":"json","value":"' || user_id || '"}' AS user,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(t):
    typed = values.typed_metadata(F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string")))
    return t.events.select("event_id", typed["kind"].alias("kind"), typed["user"].alias("user"),
                           F.try_variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


@query("f9_fence_and_json", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(t):
    fenced = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).otherwise(F.col("props"))
    return t.events.select("event_id", F.from_json(text.strip_code_fence(fenced), "k bigint")["k"].alias("k"))


@query("f10_iso_and_epoch", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, epoch_us(ts) / 1000000.0::DOUBLE AS epoch FROM events""")
def _(t):
    return t.events.select("event_id", values.iso_timestamp("ts").alias("iso"), values.epoch_seconds("ts").alias("epoch"))


@query("f11_object_id", r"""SELECT doc_id, regexp_full_match(i, '[0-9a-fA-F]{24}') AS ok FROM (
  SELECT doc_id, substr(md5(text), 1, 23 + (doc_id % 3)::INT) AS i FROM documents)""")
def _(t):
    i = F.substring(F.md5("text"), F.lit(1), (F.lit(23) + F.col("doc_id") % 3).cast("int"))
    return t.documents.select("doc_id", values.is_object_id(i).alias("ok"))


@query("f12_json_lists", """SELECT conv_id, turn, '["' || role || '","x' || turn || '"]' AS encoded, CASE WHEN turn % 2 = 0 THEN role END AS decoded FROM conversations""")
def _(t):
    encoded = values.encode_list(F.array(F.col("role"), F.concat(F.lit("x"), F.col("turn"))))
    broken = F.when(F.col("turn") % 2 == 0, encoded).otherwise(F.lit("not json"))
    return t.conversations.select("conv_id", "turn", encoded.alias("encoded"), F.try_element_at(values.decode_list(broken), F.lit(1)).alias("decoded"))


@query("f13_strip_nulls", "SELECT doc_id, md5(text || source) AS cleaned FROM documents")
def _(t):
    dirty = F.concat(F.lit("\u0000"), F.col("text"), F.lit("\u0000"), F.col("source"))
    return t.documents.select("doc_id", F.md5(text.strip_nulls(dirty)).alias("cleaned"))

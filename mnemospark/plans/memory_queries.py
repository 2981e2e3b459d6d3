"""Registered queries: store, checkpoints, history, caches, document store and ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnemospark.functions.values import typed_metadata
from mnemospark.operators import checkpoints, memory, store, tables
from mnemospark.plans import fragments as fr
from mnemospark.plans.registry import query

NOW = "2024-01-31 00:00:00"

# ---- store items: one per user, event type and value bucket; the last event wins ------------------

_ITEMS = """items AS (SELECT 'users/' || user_id || '/' || event_type AS ns_str, user_id, event_type, CAST(event_id AS VARCHAR) AS key, props AS value, ts FROM events)"""


def items(t):
    """Every event as a store item below ``users/<id>/<type>``."""
    rows = t.events.select(
        F.array(F.lit("users"), F.col("user_id").cast("string"), "event_type").alias("namespace"),
        F.col("event_id").cast("string").alias("key"), F.col("props").alias("value"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"))
    return store.with_namespace_keys(rows).drop("namespace_prefix")


@query("m1_store_get", f"""WITH {_ITEMS} SELECT ns_str, key, value FROM items JOIN
  (SELECT DISTINCT 'users/' || c_custkey || '/click' AS ns_str FROM customer) USING (ns_str)""")
def _(t):
    keys = t.customer.select(F.concat(F.lit("users/"), F.col("c_custkey"), F.lit("/click")).alias("ns_str"))
    asked = items(t).select("ns_str", "key").join(keys, "ns_str")
    return store.store_get(items(t), asked).select("ns_str", "key", "value")


@query("m1_refresh", f"""WITH {_ITEMS} SELECT ns_str, key, CASE WHEN event_type = 'click' THEN TIMESTAMP '{NOW}' ELSE ts END AS updated_at FROM items""")
def _(t):
    clicks = items(t).filter(F.col("namespace")[2] == "click")
    return store.refresh(items(t), clicks, F.to_timestamp_ntz(F.lit(NOW))).select("ns_str", "key", "updated_at")


def _ops(t):
    """Orders as a batch: puts, deletes, puts of nothing and gets on customer keys, several per key."""
    op = F.element_at(F.array(F.lit("put"), F.lit("get"), F.lit("delete"), F.lit("put")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select(
        F.col("o_orderkey").alias("seq"), op.alias("op"), F.array(F.lit("c"), F.col("o_orderstatus")).alias("namespace"),
        F.col("o_custkey").cast("string").alias("key"),
        F.when(F.col("o_orderkey") % 8 != 7, F.col("o_orderpriority")).alias("value"), F.col("o_orderdate").alias("at"))


def _before(t):
    """State before the batch: every customer under status F."""
    return t.customer.select(F.array(F.lit("c"), F.lit("F")).alias("namespace"), F.lit("c/F").alias("ns_str"), F.col("c_custkey").cast("string").alias("key"),
                             F.col("c_name").alias("value"), F.to_timestamp_ntz(F.lit("1990-01-01")).alias("created_at"), F.to_timestamp_ntz(F.lit("1990-01-01")).alias("updated_at"))


_OPS = """before AS (SELECT 'c/F' AS ns_str, CAST(c_custkey AS VARCHAR) AS key, c_name AS value, TIMESTAMP '1990-01-01' AS created_at, TIMESTAMP '1990-01-01' AS updated_at FROM customer),
ops AS (SELECT o_orderkey AS seq, ['put', 'get', 'delete', 'put'][o_orderkey % 4 + 1] AS op, 'c/' || o_orderstatus AS ns_str, CAST(o_custkey AS VARCHAR) AS key,
  CASE WHEN o_orderkey % 8 <> 7 THEN o_orderpriority END AS value, o_orderdate AS at FROM orders),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ns_str, key ORDER BY seq DESC) AS o FROM ops WHERE op <> 'get') WHERE o = 1)"""


@query("m2_store_apply", f"""WITH {_OPS}
SELECT coalesce(b.ns_str, w.ns_str) AS ns_str, coalesce(b.key, w.key) AS key, coalesce(w.value, b.value) AS value,
  coalesce(b.created_at, w.at) AS created_at, coalesce(w.at, b.updated_at) AS updated_at
FROM before b FULL OUTER JOIN w ON b.ns_str = w.ns_str AND b.key = w.key WHERE w.seq IS NULL OR (w.op = 'put' AND w.value IS NOT NULL)""")
def _(t):
    after, _reads = store.store_apply(_before(t), _ops(t))
    return after.select("ns_str", "key", "value", "created_at", "updated_at")


@query("m2_store_reads", f"""WITH {_OPS} SELECT seq, o.key, b.value, b.key IS NOT NULL AS found FROM ops o LEFT JOIN before b ON o.ns_str = b.ns_str AND o.key = b.key WHERE op = 'get'""")
def _(t):
    _after, reads = store.store_apply(_before(t), _ops(t))
    return reads.select("seq", "key", "value", "found")


@query("m3_store_search", f"""WITH {_ITEMS} SELECT ns_str, key FROM items WHERE CAST(json_extract(value, '$.k') AS BIGINT) = 7 AND event_type = 'click'""")
def _(t):
    return store.store_search(items(t), ("users", "*", "click"), filter={"k": 7}, limit=None).select("ns_str", "key")


@query("m3_store_page", f"""WITH {_ITEMS} SELECT ns_str, key FROM items WHERE starts_with(ns_str, 'users/') ORDER BY ns_str, key LIMIT 40 OFFSET 20""")
def _(t):
    return store.store_search(items(t), ("users",), limit=40, offset=20).select("ns_str", "key")


@query("m3_store_vector_search", f"""WITH {fr.CENTROIDS},
sc AS (SELECT query_id, 'vectors/' || label AS ns_str, CAST(vec_id AS VARCHAR) AS key, '{{"ns_str":"vectors/' || label || '","key":"' || vec_id || '"}}' AS id,
  {fr.cos_score('vector', 'embedding')} AS score FROM cen, embeddings WHERE label < 5)
SELECT query_id, rank, score, ns_str, key FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS rank FROM sc) WHERE rank > 2 AND rank <= 7""")
def _(t):
    rows = t.embeddings.select(F.array(F.lit("vectors"), F.col("label").cast("string")).alias("namespace"), F.col("vec_id").cast("string").alias("key"),
                               F.to_json(F.struct((F.col("label") < 5).alias("low"))).alias("value"), "embedding")
    kept = store.with_namespace_keys(rows)
    return store.store_search(kept, ("vectors",), filter={"low": True}, limit=5, offset=2, queries=fr.centroids(t)).select("query_id", "rank", "score", "ns_str", "key")


@query("m3_store_reranked", f"""WITH dv AS (SELECT conv_id, turn, text, {fr.hashed('text')} AS v FROM conversations),
gq AS (SELECT item_id AS query_id, text, {fr.hashed('text')} AS vector FROM benchmark),
sc AS (SELECT query_id, gq.text AS qt, dv.text AS dt, 'conv/' || conv_id AS ns_str, CAST(turn AS VARCHAR) AS key,
  '{{"ns_str":"conv/' || conv_id || '","key":"' || turn || '"}}' AS id, {fr.cos_score('vector', 'v')} AS score FROM gq, dv),
pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS o FROM sc) WHERE o <= 30),
rs AS (SELECT query_id, ns_str, key, id, round(CASE WHEN len({fr.toks('qt')}) = 0 THEN 0 ELSE
  len(list_intersect(list_distinct({fr.toks('qt')}), list_distinct({fr.toks('dt')})))::DOUBLE / len(list_distinct({fr.toks('qt')})) END, 6) AS score FROM pool)
SELECT query_id, rank, score, ns_str, key FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS rank FROM rs) WHERE rank <= 3""")
def _(t):
    from mnemospark.operators.embedding import hashed_embedding
    rows = t.conversations.select(F.array(F.lit("conv"), F.col("conv_id").cast("string")).alias("namespace"), F.col("turn").cast("string").alias("key"),
                                  F.to_json(F.struct("text")).alias("value"))
    kept = store.index_text(store.with_namespace_keys(rows), "text")
    asked = fr.text_queries(t).withColumn("vector", hashed_embedding("text", 64))
    found = store.store_search(kept, ("conv",), limit=3, queries=asked, rerank_field="text")
    return found.select("query_id", "rank", "score", "ns_str", "key")


@query("m4_list_namespaces", f"""WITH {_ITEMS} SELECT DISTINCT 'users/' || user_id AS ns FROM items WHERE event_type IN ('click') ORDER BY 1""")
def _(t):
    found = store.list_namespaces(items(t), prefix=("users", "*"), suffix=("*", "click"), max_depth=2, limit=None)
    return found.select(F.array_join("namespace", "/").alias("ns"))


@query("m5_expire", f"""WITH {_ITEMS} SELECT ns_str, key FROM items WHERE ts > TIMESTAMP '{NOW}' - INTERVAL 864000 SECOND""")
def _(t):
    return tables.expire(items(t), 864000, F.to_timestamp_ntz(F.lit(NOW))).select("ns_str", "key")


@query("m6_backfill_namespace", f"""WITH {_ITEMS} SELECT ns_str, key FROM items""")
def _(t):
    holes = items(t).withColumn("ns_str", F.when(F.col("value").contains("7"), F.col("ns_str")))
    return store.backfill_namespace(holes).select("ns_str", "key")


@query("m6_duplicate_keys", "SELECT 'users/' || user_id || '/' || event_type AS ns_str, props AS key, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return tables.duplicate_keys(items(t).withColumn("key", F.col("value")), ["ns_str", "key"])


@query("m7_index_text", f"""WITH e AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS index_text, {fr.hashed('text')} AS v FROM conversations)
SELECT conv_id, turn, index_text, CASE WHEN index_text IS NOT NULL THEN round(list_max(v), 6) END AS peak FROM e""")
def _(t):
    rows = t.conversations.select("conv_id", "turn", "role", F.to_json(F.struct(F.struct("text").alias("body"))).alias("value"))
    done = store.index_text(rows, "body.text", indexed=F.col("role") == "user")
    return done.select("conv_id", "turn", "index_text", F.round(F.array_max("embedding"), 6).alias("peak"))


# ---- checkpoints: one per event; user and type name the thread and namespace ---------------------

_CK = """ck AS (SELECT 'user ' || user_id AS thread_id, event_type AS checkpoint_ns, lpad(CAST(event_id AS VARCHAR), 12, '0') AS checkpoint_id, value, props, event_id, ts FROM events)"""


def _ident():
    return F.lpad(F.col("event_id").cast("string"), 12, "0")


def saved(t):
    return t.events.select(
        F.concat(F.lit("user "), F.col("user_id")).alias("thread_id"), F.col("event_type").alias("checkpoint_ns"), _ident().alias("checkpoint_id"),
        F.lit(None).cast("string").alias("parent_checkpoint_id"), F.lit("json").alias("type"), F.col("props").cast("binary").alias("checkpoint"),
        typed_metadata(F.create_map(F.lit("step"), (F.col("event_id") % 5).cast("string"), F.lit("source"),
                                    F.when(F.col("event_id") % 2 == 0, '"loop"').otherwise('"input"'))).alias("metadata"),
        F.col("ts").alias("created_at"))


def writes_of(t):
    """A pending write for every event, two for one with a large value."""
    channels = F.when(F.col("value") > 20, F.array(F.lit("out"), F.lit("__error__"))).otherwise(F.array(F.lit("out")))
    return (t.events.select(
        F.concat(F.lit("user "), F.col("user_id")).alias("thread_id"), F.col("event_type").alias("checkpoint_ns"), _ident().alias("checkpoint_id"),
        F.lit("task").alias("task_id"), F.posexplode(channels).alias("pos", "channel"),
        F.lit("").alias("task_path"), F.lit("json").alias("type"), F.col("props").alias("value"), F.col("ts").alias("created_at"))
        .withColumn("idx", checkpoints.write_index("channel", "pos")).drop("pos"))


_WR = """wr AS (SELECT 'user ' || user_id AS thread_id, event_type AS checkpoint_ns, lpad(CAST(event_id AS VARCHAR), 12, '0') AS checkpoint_id, 'task' AS task_id,
  unnest(CASE WHEN value > 20 THEN ['out', '__error__'] ELSE ['out'] END) AS channel,
  unnest(CASE WHEN value > 20 THEN [0, -1] ELSE [0] END) AS idx, props AS value FROM events)"""


@query("k1_put_checkpoint", f"""WITH {_CK} SELECT thread_id, checkpoint_ns, checkpoint_id, CASE WHEN checkpoint_ns = 'purchase' THEN 'v2' ELSE 'json' END AS type FROM ck
UNION ALL SELECT 'order', o_orderstatus, CAST(o_orderkey AS VARCHAR), 'v2' FROM orders""")
def _(t):
    old = saved(t)
    changed = old.filter(F.col("checkpoint_ns") == "purchase").withColumn("type", F.lit("v2"))
    added = t.orders.select(F.lit("order").alias("thread_id"), F.col("o_orderstatus").alias("checkpoint_ns"), F.col("o_orderkey").cast("string").alias("checkpoint_id"),
                            F.lit("v2").alias("type"))
    new = changed.unionByName(added, allowMissingColumns=True)
    return checkpoints.put_checkpoint(old, new).select("thread_id", "checkpoint_ns", "checkpoint_id", "type")


def _calls(t):
    """Every order is one call on its customer's checkpoint: special-only, mixed or ordinary channels."""
    special, mixed, plain = (F.array(*[F.lit(c) for c in names]) for names in (("__error__", "__interrupt__"), ("__error__", "out"), ("out", "log")))
    channels = F.when(F.col("o_orderkey") % 3 == 0, special).when(F.col("o_orderkey") % 3 == 1, mixed).otherwise(plain)
    return t.orders.select(F.col("o_orderkey").alias("call"), F.col("o_custkey").cast("string").alias("thread_id"), F.lit("").alias("checkpoint_ns"), F.lit("1").alias("checkpoint_id"),
                           F.lit("task").alias("task_id"), F.posexplode(channels).alias("pos", "channel"), F.lit("").alias("task_path"), F.lit("json").alias("type"),
                           F.col("o_orderpriority").alias("value"), F.col("o_orderdate").alias("created_at"))


@query("k2_put_writes", """WITH calls AS (SELECT o_orderkey AS call, CAST(o_custkey AS VARCHAR) AS thread_id, o_orderkey % 3 = 0 AS replaces,
  unnest(CASE o_orderkey % 3 WHEN 0 THEN [-1, -3] WHEN 1 THEN [-1, 1] ELSE [0, 1] END) AS idx, o_orderpriority || ' ' || o_orderkey AS value FROM orders),
base AS (SELECT CAST(c_custkey AS VARCHAR) AS thread_id, unnest([-1, 0]) AS idx, c_name AS value FROM customer)
SELECT thread_id, idx::INT AS idx, coalesce(max(last), max(base), max(first)) AS value FROM (
  SELECT thread_id, idx, arg_max(value, call) FILTER (WHERE replaces) AS last, arg_min(value, call) AS first, NULL AS base FROM calls GROUP BY thread_id, idx
  UNION ALL SELECT thread_id, idx, NULL, NULL, value FROM base) GROUP BY thread_id, idx""")
def _(t):
    base = t.customer.select(
        F.col("c_custkey").cast("string").alias("thread_id"), F.lit("").alias("checkpoint_ns"), F.lit("1").alias("checkpoint_id"), F.lit("task").alias("task_id"),
        F.explode(F.array(F.lit(-1), F.lit(0))).alias("idx"), F.lit("").alias("task_path"), F.lit("old").alias("channel"), F.lit("json").alias("type"),
        F.col("c_name").alias("value"), F.to_timestamp_ntz(F.lit(NOW)).alias("created_at"))
    calls = _calls(t).withColumn("value", F.concat_ws(" ", "value", F.col("call").cast("string")))
    return checkpoints.put_writes(base, calls).select("thread_id", "idx", "value")


@query("k3_list_checkpoints", f"""WITH {_CK}, {_WR}, kept AS (SELECT * FROM ck WHERE event_id % 5 = 2 AND event_id % 2 = 0 AND checkpoint_ns = 'click' AND checkpoint_id < '000000009000')
SELECT thread_id, checkpoint_id, task_id, idx::INT AS idx, channel FROM kept LEFT JOIN wr USING (thread_id, checkpoint_ns, checkpoint_id)""")
def _(t):
    listed = checkpoints.list_checkpoints(saved(t), checkpoint_ns="click", metadata={"step": "2", "source": '"loop"'}, before="000000009000", writes=writes_of(t))
    return listed.select("thread_id", "checkpoint_id", "task_id", "idx", "channel")


@query("k4_get_checkpoint", f"""WITH {_CK}, {_WR},
last AS (SELECT thread_id, checkpoint_ns, max(checkpoint_id) AS checkpoint_id FROM ck GROUP BY ALL),
pair AS (SELECT * FROM last UNION SELECT thread_id, checkpoint_ns, checkpoint_id FROM ck WHERE checkpoint_ns = 'error')
SELECT thread_id, checkpoint_ns, checkpoint_id, channel FROM pair LEFT JOIN wr USING (thread_id, checkpoint_ns, checkpoint_id)""")
def _(t):
    rows = saved(t)
    asked = rows.select("thread_id", "checkpoint_ns", F.lit(None).cast("string").alias("checkpoint_id")).distinct().unionByName(
        rows.filter(F.col("checkpoint_ns") == "error").select("thread_id", "checkpoint_ns", "checkpoint_id"))
    return checkpoints.get_checkpoint(rows, asked, writes_of(t)).select("thread_id", "checkpoint_ns", "checkpoint_id", "channel")


@query("w2_latest_per_thread", f"WITH {_CK} SELECT thread_id, checkpoint_ns, max(checkpoint_id) AS checkpoint_id FROM ck GROUP BY ALL")
def _(t):
    return checkpoints.latest_checkpoints(saved(t)).select("thread_id", "checkpoint_ns", "checkpoint_id")


_GONE = "gone AS (SELECT 'user ' || c_custkey AS thread_id FROM customer WHERE c_acctbal < 3000)"


@query("k5_delete_thread", f"""WITH {_CK}, {_WR}, {_GONE} SELECT 'checkpoint' AS part, thread_id, checkpoint_id FROM ck WHERE thread_id NOT IN (SELECT thread_id FROM gone)
UNION ALL SELECT 'write', thread_id, checkpoint_id FROM wr WHERE thread_id NOT IN (SELECT thread_id FROM gone)""")
def _(t):
    gone = t.customer.filter("c_acctbal < 3000").select(F.concat(F.lit("user "), F.col("c_custkey")).alias("thread_id"))
    parts = [checkpoints.delete_threads(df, gone).select(F.lit(name).alias("part"), "thread_id", "checkpoint_id")
             for name, df in (("checkpoint", saved(t)), ("write", writes_of(t)))]
    return parts[0].unionByName(parts[1])


@query("k6_time_travel", f"""WITH {_CK} SELECT thread_id, checkpoint_ns, max(checkpoint_id) AS parent_checkpoint_id, max(checkpoint_id) || '-fork' AS checkpoint_id
FROM ck WHERE event_id % 5 = 3 GROUP BY ALL""")
def _(t):
    origins = checkpoints.time_travel(saved(t), {"step": "3"})
    forks = checkpoints.fork(origins, F.concat("checkpoint_id", F.lit("-fork")))
    return forks.select("thread_id", "checkpoint_ns", "parent_checkpoint_id", "checkpoint_id")


@query("k6_lineage", """WITH chain AS (SELECT event_id % 100 AS thread, event_id, (max(event_id) OVER (PARTITION BY event_id % 100) - event_id) // 100 AS distance FROM events)
SELECT CAST(thread AS VARCHAR) AS thread_id, lpad(CAST(event_id AS VARCHAR), 12, '0') AS checkpoint_id, distance::INT AS distance FROM chain""")
def _(t):
    rows = t.events.select((F.col("event_id") % 100).cast("string").alias("thread_id"), F.lit("").alias("checkpoint_ns"), _ident().alias("checkpoint_id"),
                           F.when(F.col("event_id") >= 100, F.lpad((F.col("event_id") - 100).cast("string"), 12, "0")).alias("parent_checkpoint_id"))
    starts = rows.groupBy("thread_id", "checkpoint_ns").agg(F.max("checkpoint_id").alias("checkpoint_id"))
    return checkpoints.lineage(rows, starts).select("thread_id", "checkpoint_id", "distance")


_LEGACY = """old AS (SELECT event_id, event_type FROM events), done AS (SELECT event_id FROM events WHERE event_type = 'view')"""


@query("s12_migrate_metadata", f"""WITH {_LEGACY} SELECT event_id, '{{"type":"json","value":"\\"' || event_type || '\\""}}' AS kind FROM old WHERE event_id NOT IN (SELECT event_id FROM done)""")
def _(t):
    old = saved(t).withColumn("metadata", F.create_map(F.lit("kind"), F.to_json(F.array("checkpoint_ns"))))
    old = old.withColumn("metadata", F.transform_values("metadata", lambda _, v: F.regexp_replace(v, r"^\[|\]$", "")))
    rows, _report = checkpoints.migrate_metadata(old, old.filter("checkpoint_ns = 'view'"))
    return rows.select(F.col("checkpoint_id").cast("bigint").alias("event_id"), F.col("metadata")["kind"].alias("kind"))


@query("s12_migration_report", "SELECT count(*) AS scanned, count(*) FILTER (WHERE event_type <> 'view') AS migrated FROM events")
def _(t):
    old = saved(t)
    return checkpoints.migrate_metadata(old, old.filter("checkpoint_ns = 'view'"), dry_run=True)[1]


# ---- chat history ---------------------------------------------------------------------------

def _history(t):
    return t.conversations.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), F.to_json(F.struct("role", "text")).alias("message"))


@query("b1_messages", """SELECT session_id, seq FROM (SELECT conv_id AS session_id, turn AS seq, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n
  FROM (SELECT conv_id, turn FROM conversations UNION ALL SELECT conv_id, turn + 100 FROM conversations)
  WHERE conv_id NOT IN (SELECT item_id FROM benchmark)) WHERE n <= 3""")
def _(t):
    history = _history(t)
    more = t.conversations.select(F.col("conv_id").alias("session_id"), (F.col("turn") + 100).alias("seq"), F.col("text").alias("message"))
    cleared = memory.clear_sessions(memory.add_messages(history, more), t.benchmark.select(F.col("item_id").alias("session_id")))
    return memory.messages(cleared, 3).select("session_id", "seq")


@query("w3_last_messages", """SELECT conv_id AS session_id, turn AS seq, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n <= 2""")
def _(t):
    return memory.messages(t.conversations.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), "text"), 2)


# ---- caches ---------------------------------------------------------------------------------

def _cache(t):
    old = t.conversations.select(F.col("text").alias("prompt"), F.lit("m1").alias("llm"), F.array("role").alias("generations"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"))
    again = F.when(F.col("turn") >= 2, F.col("text")).otherwise(F.concat("text", F.lit(" again")))  # known prompts and new ones
    new = t.conversations.select(again.alias("prompt"), F.lit("m1").alias("llm"), F.array(F.lit("again"), F.col("conv_id").cast("string")).alias("generations"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"))
    empty = t.spark.createDataFrame([], "prompt string, llm string, return_val string")
    return memory.cache_update(memory.cache_update(empty, old, seq="seq"), new, seq="seq")


_CACHE = """old AS (SELECT text AS prompt, '["' || arg_max(role, conv_id * 1000 + turn) || '"]' AS return_val FROM conversations GROUP BY text),
new AS (SELECT CASE WHEN turn >= 2 THEN text ELSE text || ' again' END AS prompt, '["again","' || arg_max(conv_id, conv_id * 1000 + turn) || '"]' AS return_val FROM conversations GROUP BY 1),
cache AS (SELECT coalesce(old.prompt, new.prompt) AS prompt, 'm1' AS llm, coalesce(new.return_val, old.return_val) AS return_val FROM old FULL OUTER JOIN new ON old.prompt = new.prompt)"""


@query("x1_cache_update", f"WITH {_CACHE} SELECT prompt, llm, return_val FROM cache")
def _(t):
    return _cache(t)


@query("x1_cache_lookup", f"""WITH {_CACHE}, asked AS (SELECT conv_id, turn, text AS prompt, CASE WHEN turn < 2 THEN 'm1' ELSE 'm2' END AS llm FROM conversations)
SELECT conv_id, turn, return_val FROM asked LEFT JOIN cache USING (prompt, llm)""")
def _(t):
    asked = t.conversations.select("conv_id", "turn", F.col("text").alias("prompt"), F.when(F.col("turn") < 2, "m1").otherwise("m2").alias("llm"))
    return memory.cache_lookup(_cache(t), asked).select("conv_id", "turn", "return_val")


@query("x1_cache_clear", """WITH c AS (SELECT o_orderkey AS prompt, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS llm FROM orders) SELECT prompt, llm FROM c WHERE llm <> 'F' OR llm IS NULL""")
def _(t):
    cache = t.orders.select(F.col("o_orderkey").alias("prompt"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("llm"))
    return memory.cache_clear(cache, llm="F")


@query("x2_semantic_cache_lookup", f"""WITH {fr.CENTROIDS},
sc AS (SELECT query_id, vec_id AS id, {fr.cos_score('vector', 'embedding')} AS score FROM cen JOIN embeddings ON query_id = label),
hits AS ({fr.ranked('sc', 1)}) SELECT query_id, id, score, 'answer ' || id AS return_val FROM hits WHERE score >= 0.6""")
def _(t):
    cache = fr.vecs(t).select("id", "embedding", F.col("label").cast("string").alias("llm_string"), F.concat(F.lit("answer "), F.col("id")).alias("return_val"))
    asked = fr.centroids(t).withColumn("llm_string", F.col("query_id").cast("string"))
    return memory.semantic_cache_lookup(asked, cache, 0.6)


# ---- document store ---------------------------------------------------------------------------

def _pages(t):
    return t.documents.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("page_content"), F.col("lang").alias("metadata"))


@query("x3_docstore_mget", """SELECT item_id, pos::INT AS pos, key, md5(text) AS page_md5, doc_id IS NOT NULL AS found FROM (
  SELECT item_id, unnest([0, 1]) AS pos, unnest([CAST(item_id * 3 AS VARCHAR), 'x' || item_id]) AS key FROM benchmark) LEFT JOIN documents ON key = CAST(doc_id AS VARCHAR)""")
def _(t):
    asked = tables.asked_keys(t.benchmark.select("item_id", F.array((F.col("item_id") * 3).cast("string"), F.concat(F.lit("x"), F.col("item_id"))).alias("ks")), "ks")
    return memory.mget(_pages(t), asked).select("item_id", "pos", "key", F.md5("page_content").alias("page_md5"), "found")


@query("x3_docstore_mset", """SELECT CAST(doc_id AS VARCHAR) AS key, lang AS metadata FROM documents UNION ALL
SELECT CAST(page_id AS VARCHAR), 'page' FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'c' || conv_id, arg_min(role, turn) FROM conversations GROUP BY conv_id""")
def _(t):
    new = t.pages.select(F.col("page_id").cast("string").alias("key"), F.col("html").alias("page_content"), F.lit("page").alias("metadata"), F.col("page_id").alias("seq")).unionByName(
        t.conversations.select(F.concat(F.lit("c"), F.col("conv_id")).alias("key"), F.col("text").alias("page_content"), F.col("role").alias("metadata"), F.col("turn").alias("seq")))
    return memory.mset(_pages(t), new, seq="seq").select("key", "metadata")


@query("x3_docstore_keys", """SELECT CAST(doc_id AS VARCHAR) AS key FROM documents WHERE starts_with(CAST(doc_id AS VARCHAR), '2') AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def _(t):
    gone = t.labels.filter("toxic = 1").select(F.col("doc_id").cast("string").alias("key"))
    return memory.yield_keys(memory.mdelete(_pages(t), gone), "2")


# ---- index ledger ------------------------------------------------------------------------------

_LEDGER = """ledger AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS namespace, CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS group_id,
  epoch_us(o_orderdate) / 1000000.0::DOUBLE AS updated_at FROM orders)"""


def _ledger(t):
    from mnemospark.functions.values import epoch_seconds
    return t.orders.select(F.when(F.col("o_orderstatus") == "F", "done").otherwise("open").alias("namespace"), F.col("o_orderkey").cast("string").alias("key"),
                           F.col("o_orderpriority").alias("group_id"), epoch_seconds("o_orderdate").alias("updated_at"))


@query("c9_ledger_update", f"""WITH {_LEDGER}, up AS (SELECT DISTINCT CAST(l_orderkey * 2 AS VARCHAR) AS key FROM lineitem WHERE l_returnflag = 'R')
SELECT coalesce(l.namespace, 'open') AS namespace, coalesce(l.key, up.key) AS key, CASE WHEN up.key IS NULL THEN l.group_id ELSE 'g' END AS group_id, CASE WHEN up.key IS NULL THEN l.updated_at ELSE 1e9 END AS updated_at
FROM ledger l FULL OUTER JOIN up ON l.key = up.key AND l.namespace = 'open'""")
def _(t):
    keys = t.lineitem.filter("l_returnflag = 'R'").select((F.col("l_orderkey") * 2).cast("string").alias("key"), F.lit("g").alias("group_id"))
    return memory.ledger_update(_ledger(t), "open", keys, 1e9, time_at_least=9e8)


@query("c9_ledger_exists", f"""WITH {_LEDGER} SELECT pos, a.key, l.key IS NOT NULL AS found FROM (SELECT event_id AS pos, CAST(event_id AS VARCHAR) AS key FROM events) a
LEFT JOIN (SELECT key FROM ledger WHERE namespace = 'open') l ON a.key = l.key""")
def _(t):
    asked = t.events.select(F.col("event_id").alias("pos"), F.col("event_id").cast("string").alias("key"))
    return memory.ledger_exists(_ledger(t), "open", asked).select("pos", "key", "found")


@query("c9_ledger_list_keys", f"""WITH {_LEDGER} SELECT key FROM ledger WHERE namespace = 'open' AND updated_at > 870000000 AND updated_at < 900000000 AND group_id IN ('1-URGENT', '5-LOW')""")
def _(t):
    return memory.ledger_list_keys(_ledger(t), "open", after=870000000, before=900000000, group_ids=["1-URGENT", "5-LOW"])


@query("c9_ledger_delete", f"""WITH {_LEDGER} SELECT namespace, key FROM ledger WHERE NOT (namespace = 'done' AND CAST(key AS BIGINT) IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45))""")
def _(t):
    gone = t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").cast("string").alias("key"))
    return memory.ledger_delete(_ledger(t), "done", gone).select("namespace", "key")

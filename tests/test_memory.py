"""Keyed tables: upsert, store, checkpoints, history, caches, document store, ledger."""

import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from mnemospark.operators import checkpoints, memory, store, tables
from mnemospark.operators.embedding import hashed_embedding

T0 = dt.datetime(2024, 1, 1)


# ---- upsert ---------------------------------------------------------------------------------

def test_upsert_rules(spark):
    base = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, made string")
    up = spark.createDataFrame([("a", 10, "x", 1), ("c", 30, "first", 2), ("c", 31, "second", 3), ("a", 11, "y", 4)], "k string, v int, made string, seq int")
    assert rows(tables.upsert(base, up, ["k"], ["v"], ["made"], seq="seq")) == [("a", 11, "old"), ("b", 2, "old"), ("c", 31, "first")]
    assert rows(tables.insert_new(base, up, ["k"], seq="seq")) == [("a", 1, "old"), ("b", 2, "old"), ("c", 30, "first")]


def test_upsert_can_set_null(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    assert rows(tables.upsert(base, spark.createDataFrame([("a", None)], "k string, v int"), ["k"], ["v"])) == [("a", None)]


def test_small_updates_do_not_shuffle_the_base(spark, tmp_path):
    base = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus")
    spark.createDataFrame([(1, "Z")], "o_orderkey bigint, o_orderstatus string").write.parquet(str(tmp_path / "up"))
    up = spark.read.parquet(str(tmp_path / "up"))
    plan = tables.upsert(base, up, ["o_orderkey"], ["o_orderstatus"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_delete_rules(spark):
    df = spark.createDataFrame([("a",), ("b",)], "id string")
    assert rows(tables.delete_ids(df, ["a", "zz"])) == ["b"]
    assert tables.delete_ids(df, None).count() == 0 and tables.delete_ids(df, []).count() == 0
    assert rows(tables.get_by_ids(df, spark.createDataFrame([("b",), ("b",), ("q",)], "id string"))) == ["b"]


# ---- store ----------------------------------------------------------------------------------

NAMESPACES = [("lab", room, tool) for room in ("north", "south") for tool in ("scope", "oven", "press")] + [("lab", "south", "oven", "spare"), ("yard", "scope"), ("yard",)]


def model(prefix=(), suffix=(), max_depth=None, limit=None, offset=0):
    """Namespaces that the arguments select, in plain Python."""
    fits = lambda part, want: len(part) == len(want) and all(w in ("*", p) for p, w in zip(part, want))
    hit = [ns for ns in NAMESPACES if fits(ns[:len(prefix)], prefix) and fits(ns[len(ns) - len(suffix):] if len(ns) >= len(suffix) else (), suffix)]
    cut = sorted({ns[:max_depth] if max_depth else ns for ns in hit})[offset:]
    return cut if limit is None else cut[:limit]


def item_rows(spark, data):
    df = spark.createDataFrame([(list(ns), k, v, T0, T0) for ns, k, v in data], "namespace array<string>, key string, value string, created_at timestamp, updated_at timestamp")
    return store.with_namespace_keys(df).drop("namespace_prefix")


@pytest.mark.parametrize("kwargs", [
    dict(), dict(prefix=("lab",)), dict(prefix=("lab", "*", "oven")), dict(suffix=("scope",)), dict(suffix=("*", "oven")), dict(prefix=("yard",), suffix=("scope",)),
    dict(prefix=("lab", "south"), max_depth=2), dict(prefix=("cellar",)), dict(limit=3), dict(offset=7), dict(limit=2, offset=1), dict(suffix=("lab", "north", "oven", "spare", "x"))])
def test_list_namespaces(spark, kwargs):
    items = item_rows(spark, [(ns, f"k{i}", "{}") for i, ns in enumerate(NAMESPACES + NAMESPACES[:2])])
    got = [tuple(r["namespace"]) for r in store.list_namespaces(items, **kwargs).collect()]
    assert got == model(**kwargs)


def ops(spark, *steps):
    return spark.createDataFrame([(i, op, ["test"], "k", v, T0 + dt.timedelta(seconds=i)) for i, (op, v) in enumerate(steps)],
                                 "seq int, op string, namespace array<string>, key string, value string, at timestamp")


@pytest.mark.parametrize("before, steps, left, found", [
    ([], [("put", "1"), ("get", None), ("delete", None)], [], [False]),
    ([], [("get", None), ("delete", None), ("put", "2")], ["2"], [False]),
    ([("0",)], [("delete", None), ("get", None)], [], [True]),
    ([("0",)], [("put", "1"), ("put", "2"), ("get", None)], ["2"], [True]),
    ([("0",)], [("put", None)], [], []),
])
def test_store_batch_order(spark, before, steps, left, found):
    items = item_rows(spark, [(("test",), "k", v[0]) for v in before])
    after, reads = store.store_apply(items, ops(spark, *steps))
    assert rows(after, "value") == left and rows(reads, "found") == found


def test_store_put_keeps_creation_time(spark):
    after, _ = store.store_apply(item_rows(spark, [(("test",), "k", "0")]), ops(spark, ("get", None), ("put", "9")))
    row = after.first()
    assert row["created_at"] == T0 and row["updated_at"] == T0 + dt.timedelta(seconds=1)


def test_bad_namespaces_fail(spark):
    for bad in ([""], ["a/b"]):
        df = spark.createDataFrame([(0, "put", bad, "k", "1", T0)], "seq int, op string, namespace array<string>, key string, value string, at timestamp")
        with pytest.raises(Exception, match="invalid namespace"):
            store.store_apply(item_rows(spark, []), df)[0].collect()


def test_store_search_filters(spark):
    data = [((u, "run"), f"s{s}", f'{{"user_id":"{u}","step":{s},"meta":{{"source":"x","version":{s}}}}}') for u in ("alice", "bob") for s in (0, 1)]
    items = item_rows(spark, data)
    find = lambda **f: store.store_search(items, filter=f).count()
    assert (find(), find(user_id="alice"), find(user_id="alice", step=1), find(user_id="nobody"), find(meta={"source": "x", "version": 1})) == (4, 2, 1, 0, 2)
    assert store.store_search(items, ("bob",)).count() == 2 and store.store_search(items, limit=3).count() == 3
    assert rows(store.store_search(items, limit=2, offset=1), "ns_str", "key") == [("alice/run", "s1"), ("bob/run", "s0")]
    variant = items.withColumn("value", F.parse_json("value"))
    assert store.store_search(variant, filter={"step": 1}).count() == 2
    for bad in ({"$where": 1}, {"value": 1}):
        with pytest.raises(ValueError):
            store.store_search(items, filter=bad)


def test_store_semantic_search(spark):
    tools = [(("shed",), "t1", "steel hammer", 12), (("shed", "wall"), "t2", "copper kettle", 3), (("shed", "wall", "left"), "t3", "wooden ladder", 3), (("barn",), "t4", "wooden ladder", 1)]
    items = store.index_text(item_rows(spark, [(ns, k, json.dumps({"name": name, "stock": {"count": n}})) for ns, k, name, n in tools]), "name", 16)
    asked = spark.createDataFrame([("q", "wooden ladder")], "query_id string, text string").withColumn("vector", hashed_embedding("text", 16))
    found = store.store_search(items, ("shed",), queries=asked, limit=9).orderBy("rank").collect()
    assert [r["key"] for r in found][0] == "t3" and {r["key"] for r in found} == {"t1", "t2", "t3"}
    assert rows(store.store_search(items, ("shed", "wall"), queries=asked, limit=9), "key") == ["t2", "t3"]
    assert rows(store.store_search(items, ("shed",), queries=asked, filter={"stock.count": 12}, limit=9), "key") == ["t1"]
    ranked = store.store_search(items, ("shed",), queries=asked, limit=2, rerank_field="name").orderBy("rank").collect()
    assert ranked[0]["key"] == "t3" and ranked[0]["score"] == 1.0 and len(ranked) == 2
    assert store.store_search(items, ("shed",), queries=asked, limit=5000, rerank_field="name").count() == 3


def test_opting_out_of_the_index_keeps_rows_aligned(spark):
    items = item_rows(spark, [(("a",), "1", '{"t":"x"}'), (("a",), "2", '{"t":"y"}'), (("a",), "3", '{"other":1}')])
    got = {r["key"]: r["index_text"] for r in store.index_text(items, "t", 8, indexed=F.col("key") != "1").collect()}
    assert got == {"1": None, "2": "y", "3": None}
    with pytest.raises(ValueError):
        store.index_text(items, "t.*")


def test_backfill_and_duplicates(spark):
    items = item_rows(spark, [(("a", "b"), "k", "1"), (("a", "b"), "k", "2")])
    filled = store.backfill_namespace(items.withColumn("ns_str", F.lit(None).cast("string")))
    assert rows(filled, "ns_str") == ["a/b", "a/b"] and rows(tables.duplicate_keys(filled, ["ns_str", "key"])) == [("a/b", "k", 2)]


def test_refresh_touches_known_keys_only(spark):
    items = item_rows(spark, [(("a",), "1", "x"), (("a",), "2", "y")])
    keys = spark.createDataFrame([("a", "1"), ("a", "nope")], "ns_str string, key string")
    got = {r["key"]: r["updated_at"] for r in store.refresh(items, keys, F.lit(T0 + dt.timedelta(days=1))).collect()}
    assert got == {"1": T0 + dt.timedelta(days=1), "2": T0}


def test_expiry(spark):
    df = spark.createDataFrame([("old", T0), ("new", T0 + dt.timedelta(seconds=5)), ("undated", None)], "k string, updated_at timestamp")
    assert rows(tables.expire(df, 1, F.lit(T0 + dt.timedelta(seconds=5.5))), "k") == ["new", "undated"]
    assert rows(tables.expire(df, 1, F.lit(T0 + dt.timedelta(seconds=60))), "k") == ["undated"]


# ---- checkpoints ------------------------------------------------------------------------------

CK = ("thread_id string, checkpoint_ns string, checkpoint_id string, parent_checkpoint_id string, type string, checkpoint binary, metadata map<string,string>, created_at timestamp")


RUNS = [("alpha", "", "c05", None, dict(phase="plan", depth=0)), ("alpha", "", "c06", "c05", dict(phase="act", depth=1)), ("alpha", "sub", "c07", None, {}),
        ("beta", "", "c01", None, dict(phase="plan", depth=0)), ("beta", "", "c09", "c01", dict(phase="plan", depth=4))]


def saved(spark):
    typed = lambda kv: {k: json.dumps({"type": "json", "value": json.dumps(v)}) for k, v in kv.items()}
    return spark.createDataFrame([(t, ns, c, parent, "json", b"{}", typed(m), T0) for t, ns, c, parent, m in RUNS], CK)


def test_list_checkpoints(spark):
    ck = saved(spark)
    find = lambda **k: rows(checkpoints.list_checkpoints(ck, **k), "checkpoint_id")
    where = lambda test: sorted(r[2] for r in RUNS if test(r))
    assert find() == where(lambda r: True) and find(thread_id="alpha") == where(lambda r: r[0] == "alpha")
    assert find(thread_id="alpha", checkpoint_ns="sub") == ["c07"] and find(before="c06") == where(lambda r: r[2] < "c06") and find(limit=2) == ["c07", "c09"]
    assert find(metadata={"phase": '"plan"'}) == where(lambda r: r[4].get("phase") == "plan")
    assert find(metadata={"phase": '"plan"', "depth": "4"}) == ["c09"] and find(metadata={"phase": '"rest"'}) == []
    with pytest.raises(ValueError):
        find(metadata={"$where": "1"})


def test_lineage_follows_any_id_and_ends_in_cycles(spark):
    chain = [("t", "", str(i), str(i - 1) if i > 1 else None) for i in range(1, 13)] + [("loop", "", "a", "c"), ("loop", "", "b", "a"), ("loop", "", "c", "b")]
    ck = spark.createDataFrame(chain, "thread_id string, checkpoint_ns string, checkpoint_id string, parent_checkpoint_id string")
    starts = spark.createDataFrame([("t", "", "12"), ("loop", "", "b")], "thread_id string, checkpoint_ns string, checkpoint_id string")
    got = rows(checkpoints.lineage(ck, starts), "thread_id", "checkpoint_id", "distance")
    assert got == sorted([("t", str(i), 12 - i) for i in range(1, 13)] + [("loop", "b", 0), ("loop", "a", 1), ("loop", "c", 2)], key=str)


def writes(spark, *data):
    return spark.createDataFrame([(t, "", c, task, i, "", ch, "json", v, T0) for t, c, task, i, ch, v in data],
                                 "thread_id string, checkpoint_ns string, checkpoint_id string, task_id string, idx int, task_path string, channel string, type string, value string, created_at timestamp")


def calls(spark, *data):
    return spark.createDataFrame([(n, pos, "t", "", "1", "task", "", ch, "json", v, T0) for n, pos, ch, v in data],
                                 "call int, pos int, thread_id string, checkpoint_ns string, checkpoint_id string, task_id string, task_path string, channel string, type string, value string, created_at timestamp")


def test_put_writes(spark):
    none = writes(spark).limit(0)
    got = checkpoints.put_writes(none, calls(spark, (1, 0, "out", "a"), (1, 1, "__error__", "e1"), (2, 0, "out", "b"), (3, 0, "__error__", "e2"), (4, 0, "out", "c"), (4, 1, "__error__", "e3")))
    assert rows(got, "idx", "value") == [(-1, "e2"), (0, "a")]
    stored = writes(spark, ("t", "1", "task", 0, "out", "kept"), ("t", "1", "task", -4, "__resume__", "r0"))
    got = checkpoints.put_writes(stored, calls(spark, (1, 0, "out", "new"), (1, 1, "log", "l"), (2, 0, "__resume__", "r1")))
    assert rows(got, "idx", "value") == [(-4, "r1"), (0, "kept"), (1, "l")]


def test_get_checkpoint_and_delete(spark):
    ck, wr = saved(spark), writes(spark, ("alpha", "c05", "job", 0, "log", "one"), ("beta", "c09", "job", 0, "log", "two"), ("beta", "c09", "job", 1, "log", "three"))
    asked = spark.createDataFrame([("beta", "", None), ("alpha", "", "c05"), ("alpha", "", "c99")], "thread_id string, checkpoint_ns string, checkpoint_id string")
    assert rows(checkpoints.get_checkpoint(ck, asked, wr), "checkpoint_id", "write_value") == [("c05", "one"), ("c09", "three"), ("c09", "two")]
    gone = spark.createDataFrame([("alpha",)], "thread_id string")
    assert rows(checkpoints.delete_threads(ck, gone), "checkpoint_id") == ["c01", "c09"] and rows(checkpoints.delete_threads(wr, gone), "value") == ["three", "two"]


def test_put_checkpoint_replaces(spark):
    new = saved(spark).filter("checkpoint_id = 'c06'").withColumn("type", F.lit("msgpack"))
    assert rows(checkpoints.put_checkpoint(saved(spark), new), "checkpoint_id", "type") == sorted((r[2], "msgpack" if r[2] == "c06" else "json") for r in RUNS)


def test_time_travel_and_fork(spark):
    origin = checkpoints.time_travel(saved(spark), {"phase": '"plan"'})  # the newest of each thread
    forked = checkpoints.fork(origin, F.concat(F.lit("fork-"), F.col("thread_id")))
    assert rows(forked, "thread_id", "checkpoint_id", "parent_checkpoint_id") == [("alpha", "fork-alpha", "c05"), ("beta", "fork-beta", "c09")]


def test_lineage_of_a_long_chain(spark):
    n = 37
    ck = spark.createDataFrame([("t", "", f"{i:04d}", f"{i - 1:04d}" if i else None) for i in range(n)], "thread_id string, checkpoint_ns string, checkpoint_id string, parent_checkpoint_id string")
    starts = ck.filter(f"checkpoint_id in ('{n - 1:04d}', '0003')")
    got = checkpoints.lineage(ck, starts)
    assert rows(got.filter("start_id = '0003'"), "distance", "checkpoint_id") == [(0, "0003"), (1, "0002"), (2, "0001"), (3, "0000")]
    assert got.filter(f"start_id = '{n - 1:04d}'").agg(F.count("*"), F.max("distance"), F.countDistinct("checkpoint_id")).first() == (n, n - 1, n)


def test_migration_skips_done_rows(spark):
    legacy = saved(spark).withColumn("metadata", F.create_map(F.lit("step"), F.lit("1")))
    added, report = checkpoints.migrate_metadata(legacy, saved(spark).filter("checkpoint_id = 'c05'"))
    assert rows(report) == [(5, 4)] and rows(added.select(F.col("metadata")["step"].alias("s"))) == ['{"type":"json","value":"1"}'] * 4
    assert checkpoints.migrate_metadata(legacy, legacy.limit(0), dry_run=True)[0].count() == 0


# ---- history and caches ------------------------------------------------------------------------

def test_history(spark):
    h = spark.createDataFrame([("s", 1, "ai"), ("s", 2, "human"), ("t", 1, "x")], "session_id string, seq bigint, message string")
    more = memory.add_messages(h, spark.createDataFrame([("s", 3, "ai2")], h.schema))
    assert rows(memory.messages(more, 2), "session_id", "seq") == [("s", 2), ("s", 3), ("t", 1)]
    assert memory.messages(more).count() == 4 and memory.messages(more, 0).count() == 0
    assert rows(memory.clear_sessions(more, spark.createDataFrame([("s",)], "session_id string")), "session_id") == ["t"]


def test_exact_cache(spark):
    empty = spark.createDataFrame([], "prompt string, llm string, return_val string")
    put = spark.createDataFrame([("foo", "m", ["a", "b"]), ("bar", "m", ["c"])], "prompt string, llm string, generations array<string>")
    cache = memory.cache_update(empty, put)
    asked = spark.createDataFrame([("foo", "m"), ("foo", "other")], "prompt string, llm string")
    assert rows(memory.cache_lookup(cache, asked), "llm", "return_val") == [("m", '["a","b"]'), ("other", None)]
    assert rows(memory.cache_clear(cache, prompt="foo"), "prompt") == ["bar"] and memory.cache_clear(cache).count() == 0
    with pytest.raises(ValueError):
        memory.cache_clear(cache, llm_string="m")


@pytest.mark.parametrize("threshold, hits", [(None, ["a1", "b1"]), (0.99, ["a1"])])
def test_semantic_cache(spark, threshold, hits):
    cache = spark.createDataFrame([("a1", [1.0, 0.0], "m1", "A"), ("b1", [0.0, 1.0], "m2", "B"), ("b2", [1.0, 0.0], "m3", "C")], "id string, embedding array<double>, llm_string string, return_val string")
    asked = spark.createDataFrame([("q1", [1.0, 0.0], "m1"), ("q2", [1.0, 0.0], "m2")], "query_id string, vector array<double>, llm_string string")
    assert rows(memory.semantic_cache_lookup(asked, cache, threshold), "id") == hits


def test_docstore(spark):
    names = [f"{shelf}/{n}" for shelf in ("maps", "mappings", "charts") for n in range(7)]
    docs = spark.createDataFrame([(k, f"about {k}", "m") for k in names], "key string, page_content string, metadata string")
    for prefix in ("maps", "map", "charts/3", "none", None):
        assert rows(memory.yield_keys(docs, prefix)) == sorted(k for k in names if k.startswith(prefix or ""))
    left = memory.mdelete(docs, memory.yield_keys(docs, "maps/"))
    asked = spark.createDataFrame(list(enumerate(["charts/0", "maps/2", "charts/0", "nowhere"])), "pos int, key string")
    assert rows(memory.mget(left, asked), "pos", "found") == [(0, True), (1, False), (2, True), (3, False)]
    again = memory.mset(docs, spark.createDataFrame([("maps/1", "other", "n"), ("fresh", "p", "n")], docs.schema))
    assert again.count() == len(names) + 1 and rows(again.filter("key = 'maps/1'"), "page_content") == ["about maps/1"]


def test_ledger(spark):
    noted = [("inbox", f"mail-{c}", g, 100.0 * n) for n, (c, g) in enumerate(zip("abcdef", ["x", None, "y", "x", None, "z"]))] + [("outbox", "mail-z", "x", 50.0)]
    ledger = spark.createDataFrame(noted, "namespace string, key string, group_id string, updated_at double")
    keys = lambda **k: rows(memory.ledger_list_keys(ledger, "inbox", **k))
    inbox = lambda test: sorted(r[1] for r in noted if r[0] == "inbox" and test(r))
    assert keys() == inbox(lambda r: True) and keys(after=200.0) == inbox(lambda r: r[3] > 200) and keys(before=200.0) == inbox(lambda r: r[3] < 200)
    assert keys(after=50.0, before=450.0, group_ids=["x", "y"]) == inbox(lambda r: 50 < r[3] < 450 and r[2] in ("x", "y")) and len(keys(limit=4)) == 4
    asked = spark.createDataFrame([(0, "mail-c"), (1, "mail-z")], "pos int, key string")
    assert rows(memory.ledger_exists(ledger, "inbox", asked), "pos", "found") == [(0, True), (1, False)]
    put = spark.createDataFrame([("mail-a", "late", 7), ("mail-a", "early", 2), ("mail-q", None, 1)], "key string, group_id string, at int")
    newer = memory.ledger_update(ledger, "inbox", put, 900.0, seq="at")
    assert rows(newer.filter("updated_at = 900"), "key", "group_id") == [("mail-a", "late"), ("mail-q", None)] and newer.count() == len(noted) + 1
    gone = spark.createDataFrame([("mail-b",), ("mail-z",)], "key string")
    assert rows(memory.ledger_delete(ledger, "inbox", gone), "key") == sorted({r[1] for r in noted} - {"mail-b"})
    with pytest.raises(ValueError):
        memory.ledger_update(ledger, "inbox", asked, 5.0, time_at_least=6.0)


def test_history_comes_in_order(spark):
    said = spark.createDataFrame([(s, n, f"{s}{n}") for n in (3, 1, 2) for s in ("b", "a")], "session_id string, seq int, message string")
    assert [r["message"] for r in memory.messages(said).collect()] == ["a1", "a2", "a3", "b1", "b2", "b3"]
    assert [r["message"] for r in memory.messages(said, 2).collect()] == ["a2", "a3", "b2", "b3"]


def test_lineage_over_stops_equals_a_plain_walk(spark, monkeypatch):
    import random

    rng = random.Random(3)
    parent = {f"{i:04d}": f"{i - 1:04d}" if i % 97 else None for i in range(600)}  # chains
    parent |= {f"t{i}": f"t{rng.randrange(i)}" if i else None for i in range(300)}  # branches
    parent |= {"c0": "c1", "c1": "c2", "c2": "c0", "e": "c1", "m": "missing"}  # a cycle, an entry to it, a parent that is gone
    ck = spark.createDataFrame([("a", "", k, v) for k, v in parent.items()], "thread_id string, checkpoint_ns string, checkpoint_id string, parent_checkpoint_id string")
    asked = ["0599", "0300", "t299", "t200", "c0", "e", "m", "nowhere"]
    want = set()
    for start in asked:
        at, distance, seen = start, 0, set()
        while at in parent and at not in seen:
            seen.add(at)
            want.add((start, at, distance))
            at, distance = parent[at], distance + 1
    monkeypatch.setattr(checkpoints, "DIRECT_LINKS", 10)
    monkeypatch.setattr(checkpoints, "LONG_LEG", 64)
    starts = spark.createDataFrame([("a", "", s) for s in asked], "thread_id string, checkpoint_ns string, checkpoint_id string")
    # Walks move numbers, no keys.
    walked, plain = [], checkpoints._walk
    monkeypatch.setattr(checkpoints, "_walk", lambda reach, jump, *rest, **more: walked.append(dict(jump.dtypes)) or plain(reach, jump, *rest, **more))
    got = checkpoints.lineage(ck, starts).select("start_id", "checkpoint_id", "distance").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert len(walked) == 2 and all(w == {"from": "bigint", "to": "bigint", "length": "int"} for w in walked)

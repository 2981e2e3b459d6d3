"""Streams: watched folders, object events, keyed state, late duplicates."""

import datetime as dt
import json
import os
import time

from helpers import rows
from pyspark.sql import functions as F

from mnemospark.operators import memory
from mnemospark.plans.sync import CHUNK_SCHEMA
from mnemospark.sources.keyed import KeyedTable
from mnemospark.sources.objects import scan_objects
from mnemospark.streaming import events, state, watch


LAYOUT = {"slices": 4, "buckets": 2}


def test_watch_folder(spark, tmp_path):
    source, root, mark = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "mark")
    source.mkdir()
    (source / "a.txt").write_text("alpha beta")
    (source / "b.txt").write_text("gone soon")
    (source / "d.pdf").write_text("needs a parser")
    changes = []
    run = lambda: watch.watch_objects(spark, str(source), root, mark, once=True, layout=LAYOUT, limit=1, overlap=0,
                                      on_change=lambda df: changes.append(rows(df, "path", "change"))).awaitTermination(60)
    chunks = lambda: watch.chunk_table(spark, root, **LAYOUT).read()
    run()
    assert rows(chunks(), "content") == [" beta", " soon", "alpha", "gone"]
    assert rows(watch.file_table(spark, root, **LAYOUT).read(), "path", "status") == [("a.txt", "done"), ("b.txt", "done"), ("d.pdf", "failed")]
    run()  # nothing has changed, the object without chunks included
    (source / "b.txt").unlink()
    run()  # a deletion alone
    (source / "c.txt").write_text("new")
    run()
    assert rows(chunks(), "source_path") == ["a.txt", "a.txt", "c.txt"]
    assert changes == [[("a.txt", "created"), ("b.txt", "created"), ("d.pdf", "created")], [("b.txt", "deleted")], [("c.txt", "created")]]


def test_watch_runs_on_its_own(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    (source / "a.txt").write_text("alpha")
    seen = []
    query = watch.watch_objects(spark, str(source), root, str(tmp_path / "mark"), interval=1, layout=LAYOUT, retain=1, on_change=lambda df: seen.append(rows(df, "path", "change")))
    try:
        for wanted, act in ((1, lambda: (source / "a.txt").unlink()), (2, lambda: None)):
            for _ in range(300):
                assert query.exception() is None
                if len(seen) >= wanted:
                    break
                time.sleep(0.2)
            act()
    finally:
        query.stop()
    assert seen == [[("a.txt", "created")], [("a.txt", "deleted")]]


def test_event_stream_is_idempotent(spark, tmp_path):
    root, queue, dead = tmp_path / "objects", tmp_path / "queue", str(tmp_path / "dead")
    (root / "docs").mkdir(parents=True)
    queue.mkdir()
    (root / "docs" / "a.txt").write_text("alpha")
    (root / "docs" / "b.txt").write_text("beta")
    table = KeyedTable(spark, str(tmp_path / "table"), CHUNK_SCHEMA, "source_path", **LAYOUT)
    sink = lambda **more: events.event_sink(table, lambda: scan_objects(spark, str(root)), "docs/", dead_letters=dead, **more)

    def send(name, *messages, broken=0):
        lines = [json.dumps({"seq": s, "body": json.dumps({"Records": [{"eventName": e, "s3": {"object": {"key": k}}}]})}) for s, e, k in messages]
        (queue / name).write_text("\n".join(lines + [json.dumps({"seq": 100 + i, "body": "{broken"}) for i in range(broken)]))

    def drain(mark):
        stream = spark.readStream.schema("seq int, body string").json(str(queue))
        stream.writeStream.foreachBatch(sink()).option("checkpointLocation", str(tmp_path / mark)).trigger(availableNow=True).start().awaitTermination(60)

    send("1.json", (1, "ObjectCreated:Put", "docs/a.txt"), (2, "ObjectCreated:Put", "docs/b.txt"), (3, "ObjectCreated:Put", "docs/a.txt"), broken=2)
    drain("mark")
    assert rows(table.read(), "source_path", "content") == [("docs/a.txt", "alpha"), ("docs/b.txt", "beta")]
    assert rows(spark.read.parquet(dead), "seq", "body") == [(100, "{broken"), (101, "{broken")]
    send("2.json", (4, "ObjectRemoved:Delete", "docs/b.txt"), (5, "ObjectCreated:Put", "docs/a.txt"))
    drain("mark")
    assert rows(table.read(), "source_path") == ["docs/a.txt"] and table.last_commit() == 2
    # A replay of a batch leaves the table and its log alone.
    second = spark.read.schema("seq int, body string").json(str(queue / "2.json"))
    sink(stream="own")(second, 7)
    commits = table.last_commit()
    sink(stream="own")(second, 7)
    sink(stream="own")(spark.read.schema("seq int, body string").json(str(queue / "1.json")), 6)
    assert rows(table.read(), "source_path") == ["docs/a.txt"] and table.last_commit() == commits
    # A new checkpoint starts at batch 0 again and goes on from the table as it is.
    (root / "docs" / "c.txt").write_text("gamma")
    (queue / "1.json").unlink(), (queue / "2.json").unlink()
    send("3.json", (6, "ObjectCreated:Put", "docs/c.txt"))
    drain("another mark")
    assert rows(table.read(), "source_path") == ["docs/a.txt", "docs/c.txt"]


def test_duplicates_within_the_watermark(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "value")
    source.unionByName(source).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    query = (watch.drop_duplicates(stream, ["event_id"], "ts", "60 days").writeStream.format("memory").queryName("once")
             .option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start())
    query.awaitTermination(60)
    assert spark.table("once").count() == source.count() == spark.table("once").select("event_id").distinct().count()


def keyed(spark, tmp_path, name, ttl):
    stream = spark.readStream.schema("key string, seq bigint, value string").json(str(tmp_path / "in"))
    return (state.keyed_state(stream, ttl).writeStream.format("memory").queryName(name).outputMode("update")
            .option("checkpointLocation", str(tmp_path / "mark")))


def put(tmp_path, name, *data):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(("key", "seq", "value"), d))) for d in data))


def test_keyed_state_remembers_the_last_value(spark, tmp_path):
    put(tmp_path, "1.json", ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"))
    keyed(spark, tmp_path, "first_run", None).trigger(availableNow=True).start().awaitTermination(90)
    assert rows(spark.table("first_run"), "key", "value", "previous") == [("a", "y", None), ("b", "z", None)]


def test_an_older_write_in_a_later_batch_changes_nothing(spark, tmp_path):
    put(tmp_path, "1.json", ("a", 5, "new"), ("b", 5, None))
    query = keyed(spark, tmp_path, "late", None).start()
    try:
        query.processAllAvailable()
        for name, rows_ in (("2.json", [("a", 4, "old"), ("b", 4, "old"), ("c", 1, "x")]), ("3.json", [("a", 6, "newer"), ("b", 2, "oldest")])):
            put(tmp_path, name, *rows_)
            query.processAllAvailable()
    finally:
        query.stop()
    got = rows(spark.table("late"), "key", "value", "previous")
    assert got == sorted([("a", "new", None), ("b", None, None), ("c", "x", None), ("a", "newer", "new")], key=str)


def test_keyed_state_expires(spark, tmp_path):
    """A value outlives a pause shorter than its time to live, and not a longer one."""
    def arrived(value):
        for _ in range(300):  # with a time to live the query never runs out of batches, so look for the row
            if query.exception() is not None:
                raise query.exception()
            if spark.table("expiring").filter(F.col("value") == value).count():
                return
            time.sleep(0.2)
        raise AssertionError(f"{value} did not arrive")

    put(tmp_path, "1.json", ("a", 1, "x"))
    query = keyed(spark, tmp_path, "expiring", 12).trigger(processingTime="200 milliseconds").start()
    try:
        arrived("x")
        put(tmp_path, "2.json", ("a", 2, "y"))
        arrived("y")
        time.sleep(14)
        put(tmp_path, "3.json", ("a", 3, "z"))
        arrived("z")
    finally:
        query.stop()
    got = {r["value"]: r["previous"] for r in spark.table("expiring").collect()}
    assert got == {"x": None, "y": "x", "z": None}


def test_ntz_times_are_accepted(spark):
    df = spark.range(1).select(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(1).alias("k"))
    assert dict(watch.drop_duplicates(df, ["k"], "ts").dtypes)["ts"] == "timestamp"


def feed(spark, tmp_path, schema, *batches):
    """A stream with one micro-batch per list of rows."""
    folder = tmp_path / "feed"
    folder.mkdir(exist_ok=True)
    names = [f.split()[0] for f in schema.split(", ")]
    for i, batch in enumerate(batches):
        path = folder / f"{i}.json"
        path.write_text("\n".join(json.dumps(dict(zip(names, r))) for r in batch))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def drained(spark, tmp_path, stream, name, mode):
    (stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name))
     .trigger(availableNow=True).start().awaitTermination(120))
    return spark.table(name)


def test_history_state_equals_the_batch_operator(spark, tmp_path):
    schema = "session_id string, seq bigint, message string"
    batches = [[("a", 5, "five"), ("a", 1, "one"), ("b", 1, "only")], [("a", 3, "three"), ("a", 4, "four")],
               [("a", 2, "late and too old"), ("a", 5, "five"), ("b", 0, "late")], [("a", 4, "four again")]]
    got = drained(spark, tmp_path, state.history_state(feed(spark, tmp_path, schema, *batches), 3), "history", "update").collect()
    last = {r.session_id: [tuple(m) for m in r.messages] for r in got}  # in the order of the batches
    kept = {(s, q): (s, q, m) for batch in batches for s, q, m in batch}
    want = memory.messages(spark.createDataFrame(list(kept.values()), schema), 3).collect()
    assert last == {s: [(r.seq, r.message) for r in want if r.session_id == s] for s in ("a", "b")}
    assert len([r for r in got if r.session_id == "a"]) == 3  # the third batch changed nothing of a


def test_cache_state_equals_the_batch_operator(spark, tmp_path):
    schema = "prompt string, llm string, seq bigint, return_val string, put boolean"
    batches = [[("p", "m", 1, "x", True), ("p", "m", 2, None, False), ("p", "n", 3, None, False), ("q", "m", 4, None, False)],
               [("p", "m", 6, "y", True), ("p", "n", 5, "z", True), ("p", "m", 7, None, False)],
               [("p", "m", 2, "late", True), ("p", "m", 8, None, False), ("p", "n", 9, None, False)]]
    got = drained(spark, tmp_path, state.cache_state(feed(spark, tmp_path, schema, *batches)), "cache", "append")
    assert rows(got, "seq", "return_val", "hit") == [(2, "x", True), (3, None, False), (4, None, False), (7, "y", True), (8, "y", True), (9, "z", True)]
    puts = spark.createDataFrame([(p, m, s, [v]) for batch in batches for p, m, s, v, put in batch if put], "prompt string, llm string, seq bigint, generations array<string>")
    empty = spark.createDataFrame([], "prompt string, llm string, return_val string")
    asked = spark.createDataFrame([("p", "m"), ("p", "n"), ("q", "m")], "prompt string, llm string")
    batch = memory.cache_lookup(memory.cache_update(empty, puts, seq="seq"), asked).collect()
    final = {(r.prompt, r.llm): r.return_val for r in got.orderBy("seq").collect()}
    assert {k: None if v is None else [v] for k, v in final.items()} == {(r.prompt, r.llm): None if r.return_val is None else json.loads(r.return_val) for r in batch}


def test_ledger_state_tells_expiries(spark, tmp_path):
    schema = "namespace string, key string, group_id string, updated_at timestamp"
    at = lambda minute: f"2024-05-01T10:{minute:02d}:00Z"
    batches = [[("n", "a", "g", at(0)), ("n", "b", "g", at(1)), ("o", "a", None, at(2))], [("n", "a", "h", at(5)), ("n", "a", "late", at(3))],
               [("n", "c", "g", at(20))], [("n", "d", "g", at(40))]]
    stream = state.ledger_state(feed(spark, tmp_path, schema, *batches), 600, "1 minute", parts=4)
    got = drained(spark, tmp_path, stream, "ledger", "append").collect()
    indexed = sorted((r.namespace, r.key, r.group_id or "", r.updated_at.minute) for r in got if r.change == "indexed")
    assert indexed == [("n", "a", "g", 0), ("n", "a", "h", 5), ("n", "a", "late", 3), ("n", "b", "g", 1), ("n", "c", "g", 20), ("n", "d", "g", 40), ("o", "a", "", 2)]
    # The update of a at minute 5 put its expiry off; d is still there.
    assert sorted((r.namespace, r.key, r.updated_at.minute) for r in got if r.change == "expired") == [("n", "a", 5), ("n", "b", 1), ("n", "c", 20), ("o", "a", 2)]
    empty = spark.createDataFrame([], "namespace string, key string, group_id string, updated_at double")
    held = [r for batch in batches for r in batch if r[0] == "n"]
    ledger = memory.ledger_update(empty, "n", spark.createDataFrame([(k, g, t) for _, k, g, t in held], "key string, group_id string, seq string"), 0.0, seq="seq")
    batch = {(r.key, r.group_id) for r in ledger.collect()}
    latest = {}
    for r in sorted((r for r in got if r.change == "indexed" and r.namespace == "n"), key=lambda r: r.updated_at):
        latest[r.key] = r.group_id
    assert set(latest.items()) == batch


def test_history_state_expires(spark, tmp_path):
    schema = "session_id string, seq bigint, message string"
    stream = state.history_state(feed(spark, tmp_path, schema, [("a", 1, "x")]), 5, 8)
    query = stream.writeStream.format("memory").queryName("forgetting").outputMode("update").option("checkpointLocation", str(tmp_path / "m")).trigger(processingTime="200 milliseconds").start()
    try:
        def seen(n):
            for _ in range(300):
                assert query.exception() is None
                if spark.table("forgetting").count() >= n:
                    return
                time.sleep(0.2)
            raise AssertionError(n)
        seen(1)
        (tmp_path / "feed" / "9.json").write_text(json.dumps({"session_id": "a", "seq": 2, "message": "y"}))
        seen(2)
        time.sleep(10)
        (tmp_path / "feed" / "99.json").write_text(json.dumps({"session_id": "a", "seq": 3, "message": "z"}))
        seen(3)
    finally:
        query.stop()
    assert sorted([[m.seq for m in r.messages] for r in spark.table("forgetting").collect()], key=lambda x: x[-1]) == [[1], [1, 2], [3]]

"""Chunking, path search, synchronisation and object events on small inputs."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from mnemospark.operators import chunking, embedding, listing
from mnemospark.plans.sync import CHUNK_SCHEMA, sync
from mnemospark.streaming import events


def texts(spark, **bodies):
    return spark.createDataFrame(list(bodies.items()), "source_path string, text string")


@pytest.mark.parametrize("n, limit, overlap, count", [(0, 10, 2, 0), (1, 10, 2, 1), (10, 10, 2, 1), (11, 10, 2, 2), (18, 10, 2, 2), (19, 10, 2, 3), (100, 10, 2, 13)])
def test_token_windows(spark, n, limit, overlap, count):
    body = " ".join(f"w{i}" + ("\n" if i % 5 == 4 else "") for i in range(n))
    got = chunking.chunk_tokens(texts(spark, a=body), limit, overlap).orderBy("chunk_index").collect()
    assert [r["chunk_index"] for r in got] == list(range(count))
    for r in got:
        assert body[r["char_start"]:r["char_end"]] == r["content"]
        assert r["line_start"] == body[:r["char_start"]].count("\n") and len(r["content"].split()) <= limit
    if got:
        assert got[0]["char_start"] == 0 and got[-1]["char_end"] == len(body)


def test_user_tokenizer(spark):
    got = chunking.chunk_tokens(texts(spark, a="abcdef", b=""), 4, 1, tokenizer=list)
    assert rows(got, "content", "char_start", "char_end") == [("abcd", 0, 4), ("def", 3, 6)]


def test_chunks_are_numbered_across_pages(spark, monkeypatch):
    monkeypatch.setattr(chunking, "PAGE_BLOCK", 3)
    pages = spark.createDataFrame([("big", p, "a b c d e" if p % 2 else "x") for p in range(20)] + [("other", 1, "q")], "source_path string, page int, text string")
    got = chunking.chunk_tokens(pages, 2, 0, page_col="page").collect()
    big = sorted((r["page_number"], r["char_start"], r["chunk_index"]) for r in got if r["source_path"] == "big")
    assert [i for _, _, i in big] == list(range(len(big))) == list(range(40))
    with pytest.raises(ValueError):
        chunking.chunk_tokens(pages, 4, 4)


@pytest.fixture(scope="module")
def chunks(spark):
    data = [("docs/report.pdf", 0, "quarterly aaa report", 0), ("docs/report.pdf", 1, "a+ grade", 42), ("images/cat.png", 0, "meow", 0), ("readme.md", 0, "A+ start", 0),
            ("docs/report.pdf", 2, "a+ twice on a line", 42), ("docs2/x.md", 0, "other a+", 3)]
    return spark.createDataFrame(data, "source_path string, chunk_index int, content string, line_start int").withColumn(
        "id", F.concat_ws("#", "source_path", F.col("chunk_index").cast("string")))


def test_ls(chunks):
    assert rows(listing.ls(chunks)) == [("docs/", True), ("docs2/", True), ("images/", True), ("readme.md", False)]
    assert rows(listing.ls(chunks, "docs/")) == rows(listing.ls(chunks, "docs")) == [("docs/report.pdf", False)]
    assert listing.ls(chunks, "nowhere").count() == 0 and listing.ls(chunks, limit=2).count() == 2


def test_glob_is_relative_and_distinct(chunks):
    assert rows(listing.glob(chunks, "*.pdf", "docs/")) == ["docs/report.pdf"]
    assert listing.glob(chunks, "*.pdf").count() == 0 and rows(listing.glob(chunks, "**/*.md")) == ["docs2/x.md", "readme.md"]


def test_grep_is_literal_and_deduplicated(chunks):
    assert rows(listing.grep_literal(chunks, "a+"), "source_path", "line_start", "content") == [
        ("docs/report.pdf", 42, "a+ grade"), ("docs2/x.md", 3, "other a+"), ("readme.md", 0, "A+ start")]
    assert rows(listing.grep_literal(chunks, "a+", "docs"), "line_start") == [42]
    assert rows(listing.grep_literal(chunks, "a+", glob_pattern="*.md"), "line_start") == [0, 3]
    assert rows(listing.grep_literal(chunks, "meow", "images/cat.png"), "line_start") == [0]


def test_grep_without_vectors_uses_text(spark, chunks):
    asked = spark.createDataFrame([("q", "grade twice report")], "query_id string, text string")
    got = listing.grep_hybrid(asked, chunks, "docs", limit=20).orderBy("rank").collect()
    assert {(r["source_path"], r["line_start"]) for r in got} == {("docs/report.pdf", 0), ("docs/report.pdf", 42)} and len(got) == 2


def objects(spark, **bodies):
    df = spark.createDataFrame([(k.replace("__", "/"), v) for k, v in bodies.items()], "path string, body string")
    return df.select("path", F.md5(F.col("body").cast("binary")).alias("etag"), F.length("body").cast("bigint").alias("length"), F.col("body").cast("binary").alias("content"))


def empty(spark):
    return spark.createDataFrame([], CHUNK_SCHEMA)


def report(result):
    r = result.report.first()
    return {k: r[k] for k in ("seen", "skipped", "failed", "files_processed", "chunks_written")}


def test_sync_lifecycle(spark):
    first = sync(objects(spark, docs__a="alpha beta", docs__b="gamma"), empty(spark), limit=1, overlap=0)
    assert report(first) == dict(seen=2, skipped=0, failed=0, files_processed=2, chunks_written=3)
    table = first.chunks.cache()
    again = sync(objects(spark, docs__a="alpha beta", docs__b="gamma"), table, limit=1, overlap=0)
    assert report(again) == dict(seen=2, skipped=2, failed=0, files_processed=0, chunks_written=0)
    assert rows(again.chunks, "source_path", "chunk_index") == rows(table, "source_path", "chunk_index")
    shrunk = sync(objects(spark, docs__a="short", docs__c="new"), table, limit=1, overlap=0)
    assert rows(shrunk.chunks, "source_path", "content") == [("docs/a", "short"), ("docs/c", "new")]
    assert rows(shrunk.changes, "path", "change") == [("docs/a", "updated"), ("docs/b", "deleted"), ("docs/c", "created")]


def test_sync_guards(spark):
    objs = objects(spark, docs__a="ok", docs__big="x" * 50, other__b="fine")
    sized = sync(objs, empty(spark), max_bytes=10)
    assert report(sized) == dict(seen=3, skipped=0, failed=1, files_processed=2, chunks_written=2)
    assert rows(sized.chunks, "source_path") == ["docs/a", "other/b"]
    dry = sync(objs, empty(spark), dry_run=True)
    assert report(dry) == dict(seen=3, skipped=0, failed=0, files_processed=0, chunks_written=0) and dry.chunks.count() == 0
    assert report(sync(objs, empty(spark), prefix="other/"))["seen"] == 1


def test_sync_prefix_leaves_the_rest_alone(spark):
    table = sync(objects(spark, docs__a="x", other__b="y"), empty(spark)).chunks.cache()
    done = sync(objects(spark, docs__a="x"), table, prefix="docs/")
    assert rows(done.chunks, "source_path") == ["docs/a", "other/b"]


def body(name, key, wrapped=False):
    inner = json.dumps({"Records": [{"eventName": name, "s3": {"object": {"key": key}}}]})
    return json.dumps({"Message": inner}) if wrapped else inner


def test_object_events(spark):
    bodies = [body("ObjectCreated:Put", "docs/a"), body("ObjectRemoved:Delete", "docs/b", True), body("ObjectRestore:Post", "docs/c"), "not json", body("ObjectCreated:Put", "private/x"),
              json.dumps({"Records": [{"eventName": "ObjectCreated:Put"}]}), json.dumps({"Event": "test"}), "[1]"]
    df = spark.createDataFrame(list(enumerate(bodies)), "seq int, body string")
    got = {r["seq"]: (r["action"], r["path"]) for r in events.parse_object_events(df, "docs/", keep=("seq",)).collect()}
    assert got[0] == ("upsert", "docs/a") and got[1] == ("delete", "docs/b") and got[3][0] == "malformed" and got[7][0] == "malformed"
    assert [got[i][0] for i in (2, 4, 5, 6)] == ["ignored"] * 4


def test_events_apply_once(spark):
    objs = objects(spark, docs__a="alpha beta", docs__b="gamma")
    seq = spark.createDataFrame([(1, "upsert", "docs/a"), (2, "upsert", "docs/b"), (3, "delete", "docs/b"), (4, "upsert", "docs/gone"), (5, "ignored", None)], "seq int, action string, path string")
    once = events.apply_events(empty(spark), seq, objs, limit=1, overlap=0).cache()
    assert rows(once, "source_path", "content") == [("docs/a", " beta"), ("docs/a", "alpha")]
    twice = events.apply_events(once, seq, objs, limit=1, overlap=0)
    assert rows(twice, "source_path", "content") == rows(once, "source_path", "content")


def test_sync_tells_what_was_written_and_settles(spark):
    objects = spark.createDataFrame([("a.txt", "e1", 5, b"hello"), ("b.pdf", "e2", 3, b"%PD"), ("c.txt", "e3", 0, b""), ("big.txt", "e4", 900, b"x" * 900)],
                                    "path string, etag string, length long, content binary")
    empty = spark.createDataFrame([], CHUNK_SCHEMA)
    first = sync(objects, empty, max_bytes=500)
    seen, skipped, failed, processed, written = first.report.first()
    assert (seen, skipped, failed, processed, written) == (4, 0, 2, 1, 1)
    assert rows(first.files, "path", "status") == [("a.txt", "done"), ("b.pdf", "failed"), ("big.txt", "failed"), ("c.txt", "empty")]
    again = sync(objects, first.chunks, max_bytes=500, files=first.files)
    assert tuple(again.report.first()) == (4, 4, 0, 0, 0) and again.chunks.count() == 1


def test_one_text_that_cannot_be_embedded_fails_alone(spark):
    def picky(texts):
        if any("poison" in t for t in texts):
            raise RuntimeError("cannot read this")
        return [[float(len(t)), 1.0] for t in texts]

    objects = spark.createDataFrame([(f"f{i}.txt", f"e{i}", 10, bytearray(b"some poison here" if i == 4 else f"text {i}".encode())) for i in range(9)],
                                    "path string, etag string, length bigint, content binary").coalesce(1)
    done = sync(objects, spark.createDataFrame([], CHUNK_SCHEMA), embedder=picky, dims=2, limit=2, overlap=0)
    report = done.report.first()
    assert (report.seen, report.failed, report.files_processed) == (9, 1, 8)
    assert rows(done.chunks.select("source_path").distinct()) == [f"f{i}.txt" for i in range(9) if i != 4]
    assert rows(done.files.filter("status <> 'done'"), "path", "status") == [("f4.txt", "failed")]
    again = sync(objects, done.chunks, embedder=picky, dims=2, limit=2, overlap=0, files=done.files).report.first()
    assert (again.skipped, again.failed, again.files_processed) == (9, 0, 0)


def test_errors_of_the_embedder_are_kept_apart(spark):
    calls = embedding.embed(spark.createDataFrame([("ok",), ("bad",), (None,)], "t string").coalesce(1), "t", lambda ts: [[1 / (t != "bad")] for t in ts], 1, error="why").collect()
    assert [(r.embedding, bool(r.why)) for r in calls] == [([1.0], False), (None, True), ([1.0], False)] and "ZeroDivisionError" in calls[1].why
    assert embedding.embed(spark.createDataFrame([("a",)], "t string"), "t", error="why").first().why is None


def test_grep_hybrid_ranks_in_the_scan_and_equals_all_pairs(spark, monkeypatch):
    """Shallow ranks go deeper until the lines are certain; lines repeat, scores tie, most chunks are out of scope."""
    import random

    from mnemospark.operators.hybrid import fused_scores
    from mnemospark.operators.text_search import bm25_topk
    from mnemospark.operators.vector_search import vector_topk
    rng = random.Random(8)
    words = ["tea", "ship", "sun", "oak", "ink", "fog"]
    rows = [(f"{i:03}", f"{rng.choice(['docs', 'docs', 'else'])}/{rng.randint(0, 9)}.txt", rng.randint(0, 3), " ".join(rng.choices(words, k=rng.randint(0, 6))),
             [rng.random() for _ in range(3)]) for i in range(300)]
    chunks = spark.createDataFrame(rows, "id string, source_path string, line_start int, content string, embedding array<double>").repartition(3)
    asked = spark.createDataFrame([(1, "tea", [1.0, 0.0, 0.0]), (2, "oak fog tea", [0.0, 1.0, 0.2]), (3, "ink sun", [0.3, 0.3, 0.3]), (4, "nowhere", [1.0, 1.0, 0.0]), (5, "ship", None)],
                                  "query_id int, text string, vector array<double>")

    def plain(queries, limit):
        scope = F.col("source_path").startswith("docs/")
        legs = {"fulltext": bm25_topk(queries, chunks.select("id", "content"), None, fields=["content"], keep_ids=chunks.filter(scope).select("id"))}
        if "vector" in queries.columns:
            legs["vector"] = vector_topk(queries, chunks, 2 * limit, pre_filter=scope)
        place, best = {r[0]: r for r in rows}, {}
        for r in sorted(fused_scores(legs, dict.fromkeys(legs, 0.5)).collect(), key=lambda r: (-r["score"], r["id"])):
            best.setdefault(r["query_id"], {}).setdefault(place[r["id"]][1:3], (place[r["id"]][3], r["score"]))
        return {(q, n + 1, *line, *found) for q, lines in best.items() for n, (line, found) in enumerate([*lines.items()][:limit])}

    for depths in ((1, 2), (3,), (16, 128)):
        monkeypatch.setattr(listing, "DEPTHS", depths)
        for queries, limit in ((asked, 3), (asked.drop("vector"), 8)):
            got = listing.grep_hybrid(queries, chunks, "docs", limit=limit).select("query_id", "rank", "source_path", "line_start", "content", "score").collect()
            assert len(got) == len(set(map(tuple, got))) and {tuple(r) for r in got} == plain(queries, limit), depths
    # Where the first ranks suffice, no pair of query and chunk is made.
    monkeypatch.setattr(listing, "bm25_topk", None)
    assert listing.grep_hybrid(asked, chunks, "docs", limit=3).count() == 15

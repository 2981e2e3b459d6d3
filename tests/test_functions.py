"""Column functions: filters, globs, text and values."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from mnemospark.functions import filters, paths, text, values
from mnemospark.sources import documents, objects

MOVIES = [("Jurassic", 1993, 7.7, "scifi"), ("Inception", 2010, 8.2, None), ("Paprika", 2006, 8.6, None), ("Women", 2019, 8.3, None),
          ("Toys", 1995, None, "animated"), ("Stalker", 1979, 9.9, "thriller"), ("Heat", None, 8.3, "thriller")]


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame(MOVIES, "title string, year int, rating double, genre string")


@pytest.mark.parametrize("spec, titles", [
    ({"rating": {"$gt": 8.5}}, ["Paprika", "Stalker"]),
    ({"$and": [{"rating": {"gte": 8.3}}, {"year": {"$lt": 2010}}]}, ["Paprika", "Stalker"]),
    ({"$or": [{"genre": "scifi"}, {"year": {"$eq": 1995}}]}, ["Jurassic", "Toys"]),
    ({"genre": {"$in": "thriller"}}, ["Heat", "Stalker"]),
    ({"genre": {"$nin": ["thriller", "scifi"]}}, ["Inception", "Paprika", "Toys", "Women"]),
    ({"genre": {"$ne": "thriller"}}, ["Inception", "Jurassic", "Paprika", "Toys", "Women"]),
    ({"year": {"$gt": 2000, "$lte": 2010}}, ["Inception", "Paprika"]),
    ({"$and": [{"$or": [{"year": 1979}, {"year": 1993}]}, {"rating": {"$lt": 9}}]}, ["Jurassic"]),
    ({"rating": None}, ["Toys"]),
    ({}, sorted(m[0] for m in MOVIES)),
])
def test_filters(movies, spec, titles):
    assert rows(movies.filter(filters.filter_to_column(spec)), "title") == titles


def test_bad_filters_are_refused():
    for spec in ({"$where": 1}, {"a": {"$regex": "x"}}, {"a": {}}, {"$and": []}):
        with pytest.raises(ValueError):
            filters.filter_to_column(spec)


def test_date_markers():
    assert filters.filter_value({"date": "2025-01-01", "type": "date"}) == dt.datetime(2025, 1, 1)
    assert filters.filter_value({"datetime": "2025-01-01T10:00:00", "type": "datetime"}) == dt.datetime(2025, 1, 1, 10)
    assert filters.filter_value({"datetime": "2025-01-01T10:00:00Z", "type": "datetime"}) == dt.datetime(2025, 1, 1, 10, tzinfo=dt.timezone.utc)
    assert filters.filter_value([{"date": "2025-01-01", "type": "date"}, 3]) == [dt.datetime(2025, 1, 1), 3]
    assert filters.filter_value({"type": "Point", "x": 1}) == {"type": "Point", "x": 1}


def test_date_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    spec = {"ts": {"$gte": {"date": "2024-01-10", "type": "date"}}}
    plan = events.filter(filters.filter_to_column(spec))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_prefix_filter_reaches_the_scan(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = pages.filter(paths.under("url", "https://a")).select("page_id")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(url,https://a)" in plan and "html" not in plan.split("ReadSchema")[1]


def test_value_equality(spark):
    df = spark.createDataFrame([(1, '{"u":"a","step":1,"meta":{"v":1,"s":"x"}}'), (2, '{"u":"a","step":"1"}'), (3, '{"u":"b","ok":true,"n":null}'), (4, '{"step":1.0}')],
                               "id int, j string").withColumn("value", F.parse_json("j"))
    find = lambda spec: rows(df.filter(filters.value_equals("value", spec)), "id")
    assert find({"u": "a"}) == [1, 2]
    assert find({"step": 1}) == [1, 4]
    assert find({"step": "1"}) == [2]
    assert find({"ok": True}) == [3]
    assert find({"meta.v": 1, "u": "a"}) == [1]
    assert find({"meta": {"s": "x", "v": 1}}) == [1]
    assert find({"meta": {"v": 1}}) == []
    assert find({"values": 1}) == []
    for bad in ({"$where": 1}, {"value": 1}, {"value.u": "a"}, {"a.$gt": 1}, {"u": {"$gt": 1}}):
        with pytest.raises(ValueError):
            filters.value_equals("value", bad)


@pytest.mark.parametrize("pattern, found", [
    ("*.pdf", ["root.pdf"]),
    ("**/*.pdf", ["docs/a.pdf", "docs/deep/b.pdf", "root.pdf"]),
    ("/*.pdf", ["root.pdf"]),
    ("*.{py,md}", ["a.py", "readme.md"]),
    ("[ab].py", ["a.py"]),
    ("[!a]*.md", ["readme.md"]),
    ("?.py", ["a.py"]),
    ("docs/**", ["docs/a.pdf", "docs/deep/b.pdf"]),
    ("docs/*", ["docs/a.pdf"]),
    (".*", [".hidden"]),
    ("*", ["a+b.txt", "a.py", "f1", "f2", "readme.md", "root.pdf"]),
    ("a+b.txt", ["a+b.txt"]),
    ("f{1..2}", ["f1", "f2"]),
    ("{docs/{a,z},root}.pdf", ["docs/a.pdf", "root.pdf"]),
])
def test_globs(spark, pattern, found):
    df = spark.createDataFrame([(p,) for p in ("root.pdf", "docs/a.pdf", "docs/deep/b.pdf", "a.py", "readme.md", ".hidden", "a+b.txt", "f1", "f2")], "p string")
    assert rows(df.filter(paths.matches_glob("p", pattern)), "p") == found


def test_paths(spark):
    df = spark.createDataFrame([("docs/x/Report.PDF", ["a", "b", "c"]), (".env", [])], "p string, ns array<string>")
    got = df.select(paths.basename("p"), paths.extension("p"), paths.first_segment("p"), paths.parents("ns")).collect()
    assert tuple(got[0]) == ("Report.PDF", ".pdf", "docs", ["a", "a/b", "a/b/c"]) and tuple(got[1]) == (".env", "", ".env", [])


@pytest.mark.parametrize("body", ["one two  three\n\nfour", " lead", "trail \n", "   ", "", "x", "tab\tsep é中 文", "a\r\nb\r\n"])
def test_pieces_make_up_the_text(spark, body):
    got = spark.createDataFrame([(body,)], "t string").select(text.pieces("t")).first()[0]
    assert "".join(got) == body and ("" not in got)


def test_text_helpers(spark):
    df = spark.createDataFrame([("aXbXc\nd",)], "t string")
    got = df.select(text.occurrences("t", "X"), text.replace_first("t", "X", "--"), text.replace_first("t", "Q", "-"),
                    text.line_at("t", F.lit(6)), text.contains_ignore_case("t", "xBx"), text.tokens(F.lit("Où est-ce? A1"))).first()
    assert tuple(got) == (2, "a--bXc\nd", "aXbXc\nd", 1, True, ["où", "est", "ce", "a1"])
    with pytest.raises(ValueError):
        text.occurrences("t", "")
    fences = spark.createDataFrame([("```json\n{\"a\":1}\n```",), ("```\n{}\n```",), (" {} ",)], "t string")
    assert rows(fences.select(text.strip_code_fence("t").alias("t"))) == ['{"a":1}', "{}", "{}"]


def test_values(spark):
    df = spark.createDataFrame([("5f0c1a2b3c4d5e6f7a8b9c0d", "a\u0000b")], "i string, s string")
    assert tuple(df.select(values.is_object_id("i"), values.is_object_id("s"), text.strip_nulls("s")).first()) == (True, False, "ab")
    lists = spark.createDataFrame([('["a","b"]',), ("oops",)], "j string")
    assert [r[0] for r in lists.select(values.decode_list("j")).collect()] == [["a", "b"], None]


def test_loader_joins_dotted_fields(spark):
    """address.room = '2', content from building and room."""
    df = spark.createDataFrame([("1", ("1", "1")), ("2", ("2", "2")), ("3", ("3", "2")), ("4", (None, "2"))],
                               "_id string, address struct<building:string,room:string>")
    got = documents.load_documents(df, filter={"address.room": "2"}, field_names=["address.building", "address.room"],
                                   metadata_names=["address.building", "_id"], source_cols={"collection": "c"})
    assert got.columns == ["page_content", "address_building", "_id", "collection"]
    assert rows(got, "page_content") == [" 2", "2 2", "3 2"]
    assert rows(documents.load_documents(df.limit(1)), "page_content") == ['{"_id":"1","address":{"building":"1","room":"1"}}']


def test_profile_and_elide(spark):
    long = "x" * 30
    df = spark.createDataFrame([("a", (long, [long, "y"]), {"k": long}), (None, ("s", []), {})], "name string, n struct<bio:string,tags:array<string>>, m map<string,string>")
    profile = {r["field"]: (r["type"], r["rows"], r["non_null"]) for r in documents.profile_table(df).collect()}
    assert profile["name"] == ("string", 2, 1) and profile["n.bio"] == ("string", 2, 2) and profile["n.tags"][0] == "array<string>"
    cut = documents.sample_rows(df.filter("name = 'a'"), 3, ["name"]).first()
    assert len(cut["n"]["bio"]) == 21 and len(cut["n"]["tags"][0]) == 21 and len(cut["m"]["k"]) == 21 and cut["n"]["tags"][1] == "y"
    v = spark.createDataFrame([('{"a":1}',), ('{"b":"x"}',)], "j string").withColumn("v", F.parse_json("j"))
    assert "a: BIGINT" in documents.variant_schema(v, "v").first()[0]


def test_json_rows_are_safe(spark):
    df = spark.createDataFrame([(7, dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2), bytearray(b"hi"), [dt.date(2024, 1, 3)])],
                               "id bigint, at timestamp, day date, raw binary, days array<date>")
    assert rows(documents.to_json_rows(df, ["id"])) == [
        '{"id":"7","at":"2024-01-02T03:04:05.000000","day":"2024-01-02","raw":"aGk=","days":["2024-01-03"]}']


def test_line_windows(spark):
    df = spark.createDataFrame([("a", "l0\nl1\r\nl2\n"), ("b", ""), ("c", "only")], "path string, text string")
    assert rows(objects.read_lines(df, 1, 2)) == [("a", 1, "l1"), ("a", 2, "l2")]
    assert rows(objects.read_lines(df, 0, -1)) == [("a", 0, "l0"), ("a", 1, "l1"), ("a", 2, "l2"), ("c", 0, "only")]
    assert rows(objects.read_lines(df, 2, -1)) == [("a", 2, "l2")]
    assert objects.read_lines(df, 9, 5).count() == 0


def test_edit_counts(spark):
    df = spark.createDataFrame([("a a a",), ("none",)], "text string")
    assert rows(objects.bulk_replace_text(df, "a", "b", True), "text", "replaced") == [("b b b", 3), ("none", 0)]
    assert rows(objects.bulk_replace_text(df, "a", "b"), "text", "replaced") == [("b a a", 1), ("none", 0)]


def test_objects_on_disk(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a b+c.txt").write_bytes(b"h\xffi")
    (tmp_path / "top.md").write_text("x")
    found = objects.scan_objects(spark, str(tmp_path))
    assert rows(found, "path") == ["docs/a b+c.txt", "top.md"]
    assert rows(objects.scan_objects(spark, str(tmp_path), "docs/"), "length") == [3]
    assert rows(objects.text_from_objects(found), "text") == ["h�i", "x"]
    asked = spark.createDataFrame([(0, "top.md"), (1, "gone"), (2, "docs/a b+c.txt")], "pos int, path string")
    got = {r["pos"]: (r["content"], r["error"]) for r in objects.read_objects(asked, found, 2).collect()}
    assert got == {0: (bytearray(b"x"), None), 1: (None, "file_not_found"), 2: (None, "too_large")}
    objects.write_objects(found, str(tmp_path / "out"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).filter("folder = 'docs'"), "path") == ["docs/a b+c.txt"]


def test_objects_read_by_name(spark, tmp_path, monkeypatch):
    for name in ("a[1].txt", "b{x}.txt", "c d.txt", "e.txt"):
        (tmp_path / name).write_text(name)
    wanted = spark.createDataFrame([("a[1].txt",), ("b{x}.txt",), ("c d.txt",)], "path string")
    named = rows(objects.load_objects(spark, str(tmp_path), wanted), "path", "etag")
    assert [p for p, _ in named] == ["a[1].txt", "b{x}.txt", "c d.txt"]
    monkeypatch.setattr(objects, "MAX_NAMED", 1)
    assert rows(objects.load_objects(spark, str(tmp_path), wanted), "path", "etag") == named


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_instants_mean_the_same_in_every_zone(spark, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = F.timestamp_seconds(F.lit(1_700_000_000)) if kind == "timestamp" else F.lit("2023-11-14 22:13:20").cast("timestamp_ntz")
        df = spark.range(1).select(at.alias("ts"))
        count = lambda spec: df.filter(filters.filter_to_column({"ts": spec})).count()
        mark = lambda text: {"type": "datetime", "datetime": text}
        assert count({"$gte": mark("2023-11-14T22:13:20Z")}) == 1 and count({"$gt": mark("2023-11-14T22:13:20Z")}) == 0
        assert count({"$lt": mark("2023-11-15T07:13:21+09:00")}) == 1 and count({"$in": [mark("2023-11-14T22:13:20Z")]}) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

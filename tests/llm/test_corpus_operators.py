"""Near-duplicates, repeats, links, neighbours, revisits and the pipeline against plain versions."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mnemospark.llm import components, mixing, multi_index, near_dedup, pii, quality, queries, repeats, shingles, url_filter, warc

FOLDER = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_classes(texts, similarity=0.8):
    bags = {i: Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, t in texts.items() if (w := words_of(t))}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(bags)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = sum((bags[a] & bags[b]).values())
            if both and both / sum((bags[a] | bags[b]).values()) >= similarity:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in texts}


def near_texts():
    """Copies, chains of near copies around the threshold, and a passage that unlike texts share."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = {}
    for family in range(6):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for step in range(10):
            texts[len(texts)] = " ".join(words)
            words = list(words)
            for _ in range(family % 4):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(40):
        extra = [rng.choice(vocabulary) for _ in range(rng.randint(4, 30))]
        texts[len(texts)] = " ".join(extra[:2] + passage + extra[2:])
    texts |= {len(texts) + k: t for k, t in enumerate(["short one", "short one", "short two", None, "", "  ", "a " * 500, "a " * 480])}
    return texts


def test_near_classes_equal_all_pairs(docs, rough):
    texts = near_texts()
    got = near_dedup.near_classes(docs([(i, t, "en", "s") for i, t in texts.items()])).collect()
    want = plain_classes(texts)
    assert {r["doc_id"]: r["class"] for r in got} == want
    sizes = Counter(want.values())
    assert all(r["size"] == sizes[r["class"]] for r in got)
    odd = {r["doc_id"]: r["class"] for r in near_dedup.near_classes(docs(rough)).collect()}
    assert set(odd) == {i for i, *_ in rough if i is not None} and odd[8] == 7 and odd[1] == 1
    assert near_dedup.near_classes(docs([])).count() == 0


@pytest.mark.parametrize("edits", [(0, 3), (1, 6), (3, 5)])
def test_one_large_family_equals_all_pairs(docs, edits):
    """Copies of one text, many of them a little too far from it: no pair may be lost, and few may be compared."""
    rng = random.Random(sum(edits))
    vocabulary = [f"v{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(130)]
    texts = {}
    for _ in range(350):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2 and texts:  # a copy of a copy, which may be near to that alone
            words = rng.choice(list(texts.values())).split()
            words[rng.randrange(len(words))] = "changed"
        texts[len(texts)] = " ".join(words)
    got = near_dedup.near_classes(docs([(i, t, "en", "s") for i, t in texts.items()])).collect()
    assert {r["doc_id"]: r["class"] for r in got} == plain_classes(texts)


def test_signatures_estimate_weighted_similarity():
    a = " ".join(f"w{i} " * (1 + i % 5) for i in range(60))
    b = " ".join(f"w{i} " * (1 + (i * 7) % 6) for i in range(10, 75))
    x, y = Counter(a.split()), Counter(b.split())
    values, counts = shingles.runs(*shingles.words([a.encode(), b.encode()]), 1)
    sig = near_dedup.signatures(*near_dedup.bags(values, counts), 2, 20_000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(sum((x & y).values()) / sum((x | y).values()), abs=0.015)


def test_word_hashes():
    texts = [b"", b" a  b\tc\n", b"c", "é a".encode(), b"\x00 \x1f"]
    hashes, counts = shingles.words(texts)
    assert counts.tolist() == [0, 3, 1, 2, 2]
    assert hashes[2] == hashes[3] and hashes[0] == hashes[5] and len(set(hashes.tolist())) == 6
    values, sizes = shingles.runs(hashes, counts, 2)
    assert sizes.tolist() == [0, 2, 1, 1, 1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, k) for k in range(200, 260)] + [(260, 259), (7, 7), (300, 299)]
    got = {r["id"]: r["class"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), 5: 5, **dict.fromkeys(range(200, 261), 5), 299: 299, 300: 299}


def plain_repeats(texts, least=50):
    words = {i: words_of(t) for i, t in texts.items()}
    often = Counter(tuple(w[k:k + least]) for w in words.values() for k in range(len(w) - least + 1))
    out = {}
    for i, w in words.items():
        marked = sorted({p for k in range(len(w) - least + 1) if often[tuple(w[k:k + least])] > 1 for p in range(k, k + least)})
        for p in marked:
            spans = out.setdefault(i, [])
            if spans and spans[-1][1] == p - 1:
                spans[-1] = (spans[-1][0], p)
            else:
                spans.append((p, p))
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_repeats_equal_all_windows(docs, seed):
    """Passages of 30 to 90 words in random rows: parts of them repeat with unlike neighbours on both sides."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([30, 40, 45, 52, 60, 90]))] for _ in range(12)]
    texts = {i: " ".join(w for _ in range(rng.randint(1, 6)) for w in (rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(3, 40))])) for i in range(250)}
    texts |= {300: None, 301: "", 302: "a " * 400, 303: texts[5], 304: "w " * 49}
    got = defaultdict(list)
    for r in repeats.repeated_passages(docs([(i, t, "en", "s") for i, t in texts.items()])).collect():
        got[r["doc_id"]].append((r["first_word"], r["last_word"]))
    assert {i: sorted(s) for i, s in got.items()} == plain_repeats(texts)


def test_minimisers_of_texts_side_by_side():
    """Of several texts at once, with equal hashes in a window: as a plain search in each text gives them."""
    rng = np.random.default_rng(3)
    for window in (1, 2, 5, 41):
        counts = rng.integers(window, 3 * window + 2, 20)
        grams = rng.integers(0, 9, int(counts.sum())).astype(np.uint64)
        want, first = set(), 0
        for n in counts.tolist():
            want |= {first + i + int(grams[first + i:first + i + window].argmin()) for i in range(n - window + 1)}
            first += n
        assert repeats.minimisers(grams, counts, window).tolist() == sorted(want)


def test_windows_of_entries_are_hashed_in_one_go(monkeypatch):
    """All windows of an entry share their sums; equal windows and only these have equal hashes."""
    rng, calls, mix = np.random.default_rng(5), [], shingles.mix
    texts = [" ".join(map(str, rng.integers(0, 3, n))) for n in (49, 50, 120, 300)]
    texts += [texts[3][:400], texts[2] + " and more"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    entries = list(repeats._entries(iter([batch]), False))
    monkeypatch.setattr(shingles, "mix", lambda x: calls.append(1) or mix(x))
    rows = pa.Table.from_batches(repeats._window_hashes(iter(entries))).to_pylist()
    assert len(calls) == 2 * len(entries) and len({(r["id"], r["at"], r["l"]) for r in rows}) == len(rows)
    words, named = [t.split() for t in texts], {}
    for r in rows:
        start = r["at"] - r["l"]
        window = tuple(words[r["id"]][start:start + repeats.LEAST])
        assert start >= 0 and len(window) == repeats.LEAST and named.setdefault(window, r["h"]) == r["h"]
    assert len(set(named.values())) == len(named)
    assert {(r["id"], r["at"] - r["l"]) for r in rows} == {(i, a) for i, w in enumerate(words) for a in range(len(w) - repeats.LEAST + 1)}


def test_repeats_bear_rough_rows(docs, rough):
    assert {r["doc_id"] for r in repeats.repeated_passages(docs(rough)).collect()} == {5}
    assert repeats.repeated_passages(docs([])).count() == 0


PAGES = "page_id long, url string, html string, host string, path string, rule string, n int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", 1) for i, u, h in rows], PAGES)


def test_url_rules(spark):
    cases = {
        "https://A.Net/x": ("a.net", "/x", "net/", "block"), "http://x.example.net/en/1?q": ("x.example.net", "/en/1", "example.net/en/", "allow"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"), "http://example.com/de/a#f": ("example.com", "/de/a", "example.com/de/", "block"),
        "http://example.com/en/": ("example.com", "/en/", None, None), "ftp://q.org/fr/": ("q.org", "/fr/", "org/fr/", "allow"), "http://a.net": ("a.net", "", None, None),
        "http://a.net?x/y": ("a.net", "", None, None), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://ÄB.org/fr/": ("Äb.org", "/fr/", "org/fr/", "allow"), "": ("", "", None, "allow")}
    got = {r["page_id"]: r for r in url_filter.judge(pages_of(spark, [(i, u, None) for i, u in enumerate(cases)])).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert verdict is None or got[i]["verdict"] == verdict
    assert url_filter.judge(pages_of(spark, [])).count() == 0


def test_propagation_equals_power_iteration(spark):
    rng = np.random.default_rng(3)
    n = 12
    count = rng.integers(0, 3, (n, n)) * (1 - np.eye(n, dtype=int))
    good, bad = rng.random(n), rng.random(n)
    links = spark.createDataFrame([(f"h{i}", f"h{j}", int(count[i, j])) for i in range(n) for j in range(n) if count[i, j]], "src string, dst string, n long")
    seeds = spark.createDataFrame([(f"h{i}", float(good[i]), float(bad[i])) for i in range(n)], "host string, good double, bad double")
    out, into = np.maximum(count.sum(1), 1), np.maximum(count.sum(0), 1)
    t, d = good / 2, bad / 2
    for _ in range(40):
        t, d = good / 2 + (t / out) @ count / 2, bad / 2 + count @ (d / into) / 2
    got = {r["host"]: r for r in url_filter.propagate(seeds, links, 0.5, 30).collect()}
    assert [got[f"h{i}"]["trust"] for i in range(n)] == pytest.approx(list(t), abs=1e-5)
    assert [got[f"h{i}"]["distrust"] for i in range(n)] == pytest.approx(list(d), abs=1e-5)


def test_links_carry_distrust_to_those_who_link(spark):
    """A host that links only to blocked hosts is blocked on pages without a rule."""
    html = '<A class=x HREF="http://bad.net/p">x</A> <a href=\'HTTP://Worse.net\'>y</a> <a href="/own">z</a>'
    rows = [(1, "http://bad.net/p", None), (2, "http://worse.net/", ""), (3, "http://friend.example.com/en/", html), (4, "http://other.example.com/en/", "<a href='/x'>")]
    rules = (("block", "bad.net"), ("block", "worse.net"))
    links = url_filter.host_links(pages_of(spark, rows).withColumn("host", url_filter.host_and_path(F.col("url"))[0]), "host", "html")
    assert {(r["src"], r["dst"]) for r in links.collect()} == {("friend.example.com", "bad.net"), ("friend.example.com", "worse.net")}
    got = {r["page_id"]: r for r in url_filter.judge(pages_of(spark, rows), rules).collect()}
    assert got[3]["distrust"] > 0.4 > got[4]["distrust"] and got[3]["trust"] == 0


def plain_search(ids, x, queries_, k):
    out = {}
    for q in queries_:
        d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
        near = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in near]
    return out


def test_multi_index_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want = plain_search(ids, x, [int(i) for i in ids if i % 100 == 0], 10)
    got = defaultdict(list)
    for r in queries.QUERIES["op7_multi_index"](spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert all(len(v) == 10 and [s for _, s in v] == sorted(s for _, s in v) for v in got.values()) and set(got) == set(want)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)
    everything = multi_index.search(vectors, vectors.where("vec_id % 500 = 0"), scan=1.0).collect()
    for r in everything:
        vec, score = want[r["query_id"]][r["rank"] - 1]
        assert r["vec_id"] == vec and r["score"] == pytest.approx(score, rel=1e-12)


def test_multi_index_bears_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.1]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cell int, id int")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in multi_index.search(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7), (0, 2, 8), (0, 3, 100), (100, 1, 0), (100, 2, 7), (100, 3, 8)]
    assert multi_index.search(df.limit(0), df.limit(0)).count() == 0


def test_multi_index_keeps_rows_of_repeated_ids_and_infinite_distances(spark):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [5.0, 0.0]), (1, [2.0, 0.0]), (2, [1e200, 0.0]), (3, [-1e200, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = multi_index.search(df, df.where("vec_id = 100"), k=5, scan=1.0).collect()
    inf = float("inf")
    near = [(1, 100, 0.0), (2, 1, 1.0), (3, 100, 4.0), (4, 2, inf), (5, 3, inf)]  # of the two equal rows: each finds the other
    far = [(1, 1, 3.0), (2, 100, 4.0), (3, 100, 4.0), (4, 2, inf), (5, 3, inf)]
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(near + near + far)


def test_walk_visits_cells_by_summed_distance():
    left, right = np.array([3.0, 1.0, 2.0]), np.array([0.5, 4.0])
    sizes = np.array([1, 1, 1, 1, 0, 1])
    order = sorted(range(6), key=lambda c: left[c // 2] + right[c % 2])
    assert multi_index.walk(left, right, sizes, 99) == [c for c in order if sizes[c]]
    assert multi_index.walk(left, right, sizes, 2) == [c for c in order if sizes[c]][:2]


RECORDS = "record_id long, url string, at long, kind string, status int, etag string, modified string, headers map<string,string>, body string, bucket int"


def test_revisits(spark):
    def record(i, url, at, kind, status=200, etag=None, modified=None, headers=None, body=None):
        return (i, url, at, kind, status, etag, modified, headers, body, 5)

    rows = [record(1, "http://h/a", 10, "response", etag='"x"', headers={"Server": "s", "Date": "old"}, body="first"), record(2, "http://h/a", 20, "response", etag='"y"', body="second"),
            record(3, "HTTP://H:80/a#f", 25, "revisit", 304, 'W/"y"', headers={"Date": "new", "Server": "t"}), record(4, "http://h/a", 15, "revisit", 304, '"x"', headers={"date": "mid"}),
            record(5, "http://h/a", 5, "revisit", 304, '"x"'), record(6, "http://h/a", 20, "revisit", 304, '"x"'), record(7, None, 30, "revisit", 304, '"x"'), record(8, "http://h/a", None, "revisit", 304, '"y"'),
            record(9, "http://h/b", 10, "response", 500, '"q"', body="error"), record(10, "http://h/b", 20, "revisit", 304, '"q"'), record(11, "http://h", 1, "response", modified="d1", body="root"),
            record(12, "http://h/", 2, "revisit", 304, '"z"', "d1"), record(13, "http://h/", 2, "revisit", 304)]
    got = {r["record_id"]: r for r in warc.resolve(spark.createDataFrame(rows, RECORDS)).collect()}
    assert {i: (r["refers_to"], r["resolved"], r["body"]) for i, r in got.items()} == {
        3: (2, True, "second"), 4: (1, True, "first"), 5: (None, False, None), 6: (2, False, None), 7: (None, False, None), 8: (None, False, None),
        10: (None, False, None), 12: (11, True, "root"), 13: (11, False, None)}
    assert got[4]["headers"] == {"server": "s", "date": "mid"} and got[3]["headers"] == {"date": "new"}
    assert warc.resolve(spark.createDataFrame([], RECORDS)).count() == 0


def plain_revisits(rows):
    """Each revisit against all responses: (record_id, refers_to, resolved, body, headers)."""
    key = lambda url: re.sub("^(http://[^/]*?)(:80)?/", r"\1/", url.split("#")[0].replace("HTTP://H", "http://h"))
    lower = lambda m: {k.lower(): v for k, v in m.items()}
    full = [r for r in rows if r["kind"] == "response" and r["status"] == 200 and None not in (r["record_id"], r["url"], r["at"])]
    out = []
    for r in (r for r in rows if r["kind"] == "revisit"):
        known = [] if r["url"] is None or r["at"] is None else [f for f in full if key(f["url"]) == key(r["url"]) and f["at"] <= r["at"]]
        best = max(known, key=lambda f: (f["at"], f["record_id"]), default=None)
        tag = best and best["etag"] and r["etag"]
        ok = bool(best) and (best["etag"] == r["etag"].removeprefix("W/") if tag else bool(best["modified"] and r["modified"]) and best["modified"] == r["modified"])
        merged = {**lower(best["headers"]), **{k: v for k, v in lower(r["headers"]).items() if k in warc.MERGED}} if ok else r["headers"]
        out.append((r["record_id"], best and best["record_id"], ok, best["body"] if ok else r["body"], tuple(sorted(merged.items()))))
    return out


@pytest.mark.parametrize("rows_a_bucket", [warc.BUCKET_ROWS, 1])
def test_revisits_that_repeat_and_clash(spark, monkeypatch, rows_a_bucket):
    """Repeated rows and ids, a response that most revisits refer to, clashing columns, header case; against a plain version."""
    monkeypatch.setattr(warc, "BUCKET_ROWS", rows_a_bucket)  # 1: buckets of both levels
    monkeypatch.setattr(warc, "SHARED_BY", 8)
    rng = random.Random(3)
    names = ["record_id", "url", "at", "kind", "status", "etag", "modified", "headers", "body", "resolved", "refers_to", "_id", "_headers", "record", "part", "found.x"]
    extra = ["r", 1, 2, "h", "rec", 3, "dot"]
    urls = [None, "http://h/a", "HTTP://H:80/a#f", "http://h/b", "http://h/"]
    rows = []
    for i in range(400):
        kind = rng.choice(["response", "revisit", "revisit"])
        mark = rng.choice(["x", "y"]) if i % 9 else None
        headers = {"Age": str(i), "age": str(i + 1), "Server": "s"} if i % 3 else {"Date": str(i)}
        at = rng.choice([None, *range(0, 300, 2)]) if i % 5 else 500
        rows.append([i if i % 50 else None, rng.choice(urls), at, kind, 200 if kind == "response" else 304, mark and (f"W/{mark}" if kind == "revisit" and i % 2 else mark),
                     f"d{i % 2}" if i % 7 else None, headers, f"body {i}" if kind == "response" else None, *extra])
    rows.append([1000, "http://h/hot", 10, "response", 200, "x", None, {"Server": "hot"}, "hot body", *extra])
    rows += [[2000 + i, "http://h/hot", 20 + i, "revisit", 304, "x", None, {"AGE": "1"}, None, *extra] for i in range(60)]
    rows += [r for r in rows if r[3] == "revisit"][::4] * 2 + [r for r in rows if r[3] == "response"][::6]
    types = "long string long string int string string array<struct<key:string,value:string>> string string int int string string int string".split()
    made = spark.createDataFrame([(*r[:7], list(r[7].items()), *r[8:]) for r in rows], ", ".join(f"`{n}` {t}" for n, t in zip(names, types)))
    got = warc.resolve(made.withColumn("headers", F.map_from_entries("headers")))  # keeps their order
    assert got.columns == [n for n in names if n not in ("resolved", "refers_to")] + ["url_key", "refers_to", "resolved"]
    found = [(r["record_id"], r["refers_to"], r["resolved"], r["body"], tuple(sorted((r["headers"] or {}).items()))) for r in got.collect()]
    want = plain_revisits([dict(zip(names, r)) for r in rows])
    assert Counter(found) == Counter(want) and sum(f[2] for f in found) > 100
    assert got.where("`found.x` <> 'dot' or part <> 3").count() == 0


def test_revisit_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{FOLDER}/pages.parquet')")
    names = ["record_id", "refers_to", "resolved", "body_sha256", "headers"]
    want = con.sql(f"SELECT {', '.join(names)} FROM ({queries.OP6_SQL})").fetchall()
    got = [tuple(r) for r in queries.QUERIES["op6_warc_revisits"](spark, FOLDER).select(*names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pipeline_decisions_take_effect(spark):
    """Each stage against a plain reading of what the operator decides on the stage's own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
    now = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    assert now.columns == columns and {r["doc_id"] for r in now.collect()} == kept
    classes = plain_classes({i: seen[i] for i in kept})
    now = corpus_pipeline.near_duplicates(spark, now, FOLDER)
    assert now.columns == columns and {r["doc_id"] for r in now.collect()} == set(classes.values())
    clean = corpus_pipeline.personal_data(spark, now, FOLDER)
    assert clean.columns == columns
    for r in clean.collect():
        assert not pii.base_spans(r["text"]) and (r["text"] == seen[r["doc_id"]]) == (not pii.base_spans(seen[r["doc_id"]]))
    mixed = corpus_pipeline.source_mix(spark, clean, FOLDER)
    taken = {r["doc_id"]: len(r["places"]) for r in mixing.mix(clean).collect()}
    assert mixed.columns == columns and Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in taken.items() if n})
    ids = corpus_pipeline.token_ids(spark, mixed, FOLDER)
    assert ids.count() == sum(taken.values()) and ids.where("n_tokens = 0 or size(ids) <> n_tokens").count() == 0


def test_pipeline_bears_rough_rows(spark, docs, rough):
    now = docs(rough).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, FOLDER)
    assert now.count() == 0 or now.where("n_tokens is null").count() == 0


def test_near_classes_compare_all_texts_of_repeated_ids(docs):
    texts = near_texts()
    rows = [(i, t) for i, t in texts.items() if i < 30]  # three families of near copies
    alone, other = " ".join(f"u{k}" for k in range(40)), " ".join(f"z{k}" for k in range(40))
    # 1000 has a text of another id and one that only 1001 is near to; 1002 has one text twice and a blank one.
    rows += [(1000, texts[40]), (1002, texts[40]), (1000, alone), (1001, alone + " more"), (1002, other), (1002, other), (1002, " "), (1003, other)]
    got = {r["doc_id"]: (r["class"], r["size"]) for r in near_dedup.near_classes(docs([(i, t, "en", "s") for i, t in rows])).collect()}
    plain = plain_classes({i: t for i, t in rows if i < 1000})
    size = Counter(plain.values())
    assert got == {i: (c, size[c]) for i, c in plain.items()} | {i: (1000, 4) for i in (1000, 1001, 1002, 1003)}


def test_pipeline_keeps_the_rows_of_null_and_repeated_ids(spark, docs):
    """Kept rows against plain versions, by all columns."""
    rng = random.Random(3)
    words = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
    unlike = [words(rng.randint(60, 90)) for _ in range(40)]
    rows = [(None if k % 4 == 0 else 7 if k % 4 == 1 else 100 + k, t, "en", "ab"[k % 2]) for k, t in enumerate(unlike)]
    rows += [rows[0], rows[1], rows[2], (500, unlike[5], "en", "a"), (3, unlike[9], "en", "b"), (None, unlike[10], "de", "a"), (900, "too few words", "en", "a"), (None, "too few", "en", "a")]
    table = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    plain = lambda df: Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect())
    now = corpus_pipeline.quality_rules(spark, table, FOLDER)
    long = Counter(r for r in rows if len(r[1].split()) >= 50)
    assert plain(now) == long
    now = corpus_pipeline.near_duplicates(spark, now, FOLDER)
    want = {}
    for r in sorted(long, key=lambda r: (r[0] is None, r[0] or 0)):
        want.setdefault(r[1], r)  # the texts are copies or unlike
    assert plain(now) == Counter(want.values())
    mixed = corpus_pipeline.source_mix(spark, table, FOLDER)
    places = Counter()
    whole = {r["_row"]: (r["doc_id"], r["text"], r["lang"], r["source"]) for r in corpus_pipeline.keyed(table).collect()}
    for r in mixing.mix(corpus_pipeline.keyed(table), carry=("_row",)).collect():
        places[whole[r["_row"]]] += len(r["places"])
    assert plain(mixed) == +places
    blank = docs([(None, " ", "en", "a")] * 2 + [(1, None, "en", "a")] * 2).select("doc_id", "text", "lang", "source", "n_chars")
    assert corpus_pipeline.near_duplicates(spark, blank, FOLDER).count() == 4  # blank texts stay alone


def test_links_without_a_scheme_carry_distrust(spark):
    html = '<a href="//bad.net/x">x</a> <a href=/own//path>y</a> <a href="own//path">z</a> <a href="//h.test/own">o</a>'
    pages = spark.createDataFrame([(1, "http://h.test/", html), (2, "http://bad.net/x", "")], "page_id long, url string, html string")
    links = url_filter.host_links(pages.withColumn("host", url_filter.host_and_path(F.col("url"))[0]), "host", "html").collect()
    assert [tuple(r) for r in links] == [("h.test", "bad.net", 1)]
    got = {r["page_id"]: r["distrust"] for r in url_filter.judge(pages).collect()}
    assert got[1] > 0 and got[2] > 0

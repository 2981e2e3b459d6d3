"""Search semantics on small hand-made inputs."""

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from mnemospark.functions.vectors import cosine_similarity, similarity
from mnemospark.operators import hybrid, mmr, parents, text_search, vector_search
from mnemospark.operators.embedding import (QuotaExhausted, RateLimited, add_texts, embed, with_retry)
from mnemospark.operators.ranking import number_all, top_k

#: Notes of a harbour; the last shares no word with the others.
NOTES = ["The red boat came with salt", "The blue boat came with timber", "A boat with copper wire waits at the far northern pier", "Gulls sleep. Gulls wake."]


@pytest.fixture(scope="module")
def sentences(spark):
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(NOTES)], "id string, text string")
    return embed(df, "text", dims=32).cache()


def asked(spark, text, dims=32):
    return embed(spark.createDataFrame([("q", text)], "query_id string, text string"), "text", dims=dims, output="vector")


@pytest.fixture(scope="module")
def random_vectors(spark):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(600, 16)).round(3)
    m[100:110] = m[0]  # ties
    return m, spark.createDataFrame([(i, [float(x) for x in v], int(i % 3)) for i, v in enumerate(m)],
                                    "id bigint, embedding array<double>, label int").repartition(5)


def brute(m, q, k, metric="cosine", keep=None):
    if metric == "cosine":
        s = (1 + m @ q / (np.linalg.norm(m, axis=1) * np.linalg.norm(q))) / 2
    elif metric == "dotProduct":
        s = (1 + m @ q) / 2
    else:
        s = 1 / (1 + np.linalg.norm(m - q, axis=1))
    s = s.round(6)
    ids = [i for i in range(len(m)) if keep is None or keep(i)]
    return [(i, s[i]) for i in sorted(ids, key=lambda i: (-s[i], i))[:k]]


@pytest.mark.parametrize("metric", ["cosine", "dotProduct", "euclidean"])
@pytest.mark.parametrize("block", [4096, 4])
def test_vector_topk_is_exact(spark, random_vectors, metric, block):
    """Both ways, queries in the tasks and queries in blocks, equal brute force, ties by id."""
    m, corpus = random_vectors
    queries = spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in range(0, 60, 5)], "query_id bigint, vector array<double>")
    got = vector_search.vector_topk(queries, corpus, 7, metric=metric, query_block=block).collect()
    for q in range(0, 60, 5):
        mine = sorted((r["rank"], r["id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(i, s) for _, i, s in mine] == [(i, pytest.approx(s, abs=2e-6)) for i, s in brute(m, m[q], 7, metric)]
        assert [r for r, _, _ in mine] == list(range(1, 8))


@pytest.mark.parametrize("block", [4096, 2])
def test_within_and_filter(spark, random_vectors, block):
    m, corpus = random_vectors
    queries = spark.createDataFrame([(i, [float(x) for x in m[i]], i % 3) for i in range(9)], "query_id bigint, vector array<double>, label int")
    got = vector_search.vector_topk(queries, corpus, 4, within=["label"], pre_filter={"id": {"$gte": 50}}, query_block=block).collect()
    for q in range(9):
        mine = [i for _, i in sorted((r["rank"], r["id"]) for r in got if r["query_id"] == q)]
        assert mine == [i for i, _ in brute(m, m[q], 4, keep=lambda i, q=q: i % 3 == q % 3 and i >= 50)]


def test_hot_key_in_within(spark, random_vectors):
    """One key holds almost everything; its rows stay spread over the scan tasks."""
    m, corpus = random_vectors
    hot = corpus.withColumn("label", F.when(F.col("id") < 590, 0).otherwise(1))
    queries = spark.createDataFrame([(0, [float(x) for x in m[5]], 0)], "query_id bigint, vector array<double>, label int")
    got = vector_search.vector_topk(queries, hot, 3, within=["label"]).orderBy("rank").collect()
    assert [r["id"] for r in got] == [i for i, _ in brute(m, m[5], 3, keep=lambda i: i < 590)]


def test_filter_applies_before_topk(spark):
    """The nearest rows fail the filter; those that pass are still found."""
    corpus = spark.createDataFrame([(f"r{i}", [1.0, i / 10], None if i % 3 else i) for i in range(12)], "id string, embedding array<double>, weight int")
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<double>")
    assert vector_search.vector_topk(queries, corpus, 2, pre_filter={"weight": {"$lt": 0}}).count() == 0
    assert rows(vector_search.vector_topk(queries, corpus, 2, pre_filter={"weight": {"$gt": 3}}), "id") == ["r6", "r9"]


@pytest.mark.parametrize("metric", ["cosine", "dotProduct", "euclidean"])
def test_nan_and_infinity_push_out_nobody(spark, metric):
    good = [[1.0, 0.0], [0.8, 0.6], [0.0, 1.0]]
    odd = [[float("nan"), 1.0], [float("inf"), 0.0], [float("nan"), float("nan")]]
    corpus = spark.createDataFrame([(i, v) for i, v in enumerate(good + odd)], "id bigint, embedding array<double>").coalesce(1)
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<double>")
    for k in (1, 2):
        got = vector_search.vector_topk(queries, corpus, k, metric=metric).orderBy("rank").collect()
        assert [r["id"] for r in got] == [0, 1][:k]


def test_width_mismatch(spark):
    corpus = spark.createDataFrame([("1", [1.0, 0.0, 0.0])], "id string, embedding array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<double>")
    with pytest.raises(Exception, match="widths differ"):
        vector_search.vector_topk(queries, corpus, 1).collect()
    pair = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="widths differ"):
        pair.select(cosine_similarity("a", "b")).collect()


def test_zero_vector_scores_zero(spark):
    pair = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert pair.select(cosine_similarity("a", "b")).first()[0] == 0.0
    assert pair.select(similarity("cosine", "a", "b")).first()[0] == 0.5


def test_ann_recall(spark, random_vectors):
    m, corpus = random_vectors
    queries = spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in range(200, 240)], "query_id bigint, vector array<double>")
    cells, pivots = vector_search.build_cells(corpus, 12)
    near = vector_search.ann_topk(queries, cells, pivots, 5, oversampling=40).select("query_id", "id")
    exact = vector_search.vector_topk(queries, corpus, 5).select("query_id", "id")
    found = near.intersect(exact).count() / exact.count()
    assert found > 0.6
    everything = vector_search.ann_topk(queries, cells, pivots, 5, oversampling=600).select("query_id", "id")
    assert everything.exceptAll(exact).isEmpty()


def test_ann_reads_probed_cells_only(spark, random_vectors, tmp_path):
    m, corpus = random_vectors
    cells, pivots = vector_search.build_cells(corpus, 12)
    cells.write.partitionBy("cell").parquet(str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells"))
    queries = spark.createDataFrame([(1, [float(x) for x in m[3]])], "query_id bigint, vector array<double>")
    near = vector_search.ann_topk(queries, stored, pivots, 2, oversampling=1)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert near.count() == 2 and near.filter("rank = 1").first()["score"] == 1.0


def test_mmr_repeats_text_last(spark):
    """Three equal rows: after the first, rows that differ come before its repetitions."""
    texts, angle = ["ash", "ash", "oak", "ash", "elm"], {"ash": 0.0, "oak": 0.4, "elm": 0.9}
    vec = {t: [float(np.cos(a)), float(np.sin(a))] for t, a in angle.items()}
    corpus = spark.createDataFrame([(i, t, vec[t]) for i, t in enumerate(texts)], "id bigint, text string, embedding array<double>")
    queries = spark.createDataFrame([("q", vec["ash"])], "query_id string, vector array<double>")
    got = [r["text"] for r in mmr.mmr(queries, corpus, 9, lambda_mult=0.15).join(corpus, "id").orderBy("rank").collect()]
    assert len(got) == 5 and got[0] == "ash" and got[1] != "ash"


def test_text_search_ranks_match_first(spark, sentences):
    got = text_search.bm25_topk(asked(spark, "which boat has copper wire?"), sentences, 4).orderBy("rank").collect()
    assert got[0]["id"] == "2"
    assert "3" not in [r["id"] for r in got]


def test_text_index_round_trip(spark, sentences, tmp_path):
    index = text_search.build_text_index(sentences, ["text"], keyword_fields=["id"])
    index.save(str(tmp_path / "ix"), buckets=2)
    loaded = text_search.TextIndex.load(spark, str(tmp_path / "ix"))
    q = asked(spark, "blue boat timber")
    direct = text_search.bm25_topk(q, sentences, None)
    stored = text_search.bm25_topk(q, loaded, None, fields=["text"])
    assert rows(direct) == rows(stored)


def test_text_filter_comes_before_limit(spark, sentences):
    keep = text_search.matching_ids(sentences, F.col("text").contains("blue"))
    assert rows(text_search.bm25_topk(asked(spark, "boat"), sentences, 1, keep_ids=keep), "id") == ["1"]


def test_shuffled_terms_equal_broadcast_terms(spark, sentences, monkeypatch):
    q = asked(spark, "blue boat gulls")
    few = rows(text_search.bm25_topk(q, sentences, 4))
    monkeypatch.setattr(text_search, "TERM_BOUND", 1)
    assert rows(text_search.bm25_topk(q, sentences, 4)) == few


@pytest.mark.parametrize("weights", [(1.0, 0.0), (0.0, 1.0), (0.3, 0.7)])
def test_weighted_fusion(spark, sentences, weights):
    """Each fused score is the weighted sum of the two legs' own reciprocal ranks."""
    q = asked(spark, "gulls boat")
    text, vector = weights
    legs = [{r["id"]: 1 / (r["rank"] + 60) for r in leg.collect()} for leg in
            (text_search.bm25_topk(q, sentences, 4), vector_search.vector_topk(q, sentences, 4))]
    got = {r["id"]: r["score"] for r in hybrid.hybrid_topk(q, sentences, 4, fulltext_weight=text, vector_weight=vector).collect()}
    assert got == {i: pytest.approx(text * legs[0].get(i, 0) + vector * legs[1].get(i, 0), abs=1e-6) for i in got} and len(got) == 4


def test_reciprocal_rank_formula(spark):
    ranked = spark.createDataFrame([("q", "a", 1, 9.0), ("q", "b", 2, 8.0)], "query_id string, id string, rank int, score double")
    got = {r["id"]: r["score"] for r in hybrid.reciprocal_rank(ranked, 60, 2.0).collect()}
    assert got == {"a": pytest.approx(2 / 61), "b": pytest.approx(2 / 62)}


def test_rerank_trims_and_overwrites(spark, sentences):
    q = asked(spark, "copper boat wire")
    hits = text_search.bm25_topk(q, sentences, 3)
    got = hybrid.rerank(hits, q, sentences, num_docs=3, k=1).collect()
    assert [(r["id"], r["score"], r["rerank_score"]) for r in got] == [("2", 1.0, 1.0)]
    with pytest.raises(ValueError):
        hybrid.rerank(hits, q.drop("text"), sentences)
    with pytest.raises(ValueError):
        hybrid.rerank(hits, q, sentences, num_docs=0)


def test_rerank_with_pandas_model(spark, sentences):
    import pandas as pd

    @F.pandas_udf("double")
    def length(query: pd.Series, text: pd.Series) -> pd.Series:
        return text.str.len().astype(float)

    q = asked(spark, "boat")
    hits = text_search.bm25_topk(q, sentences, 3)
    assert hybrid.rerank(hits, q, sentences, length, k=1).first()["id"] == "2"


def test_parents_are_distinct_and_ordered(spark):
    docs = spark.createDataFrame([("p1", "a" * 900), ("p2", "b" * 300)], "id string, text string")
    chunks = parents.split_children(docs, 400)
    assert chunks.count() == 4
    hits = chunks.select(F.lit("q").alias("query_id"), "id", F.when(F.col("doc_id") == "p1", 0.2 + F.col("chunk_index") / 10).otherwise(0.3).alias("score"))
    got = parents.parent_documents(hits, chunks, docs, k=5).orderBy("rank").collect()
    assert [(r["id"], round(r["score"], 2)) for r in got] == [("p1", 0.4), ("p2", 0.3)]


def test_number_all_on_one_hot_key(spark):
    df = spark.range(5000).select(F.lit("hot").alias("query_id"), "id", (F.col("id") % 7).cast("double").alias("score")).repartition(6)
    got = number_all(df, ["query_id"], [F.desc("score"), F.asc("id")], "rank").orderBy("rank").collect()
    want = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert [r["id"] for r in got] == want and [r["rank"] for r in got] == list(range(1, 5001))


def test_top_k_trims_before_the_shuffle(spark):
    plan = top_k(spark.range(10).select((F.col("id") % 2).alias("query_id"), "id", F.rand(1).alias("score")), 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_user_embedder_and_retry(spark):
    calls = []

    def flaky(texts):
        calls.append(1)
        if len(calls) < 3:
            raise RateLimited
        return [[1.0, 2.0] for _ in texts]

    waits = []
    assert with_retry(flaky, ["a"], waits.append) == [[1.0, 2.0]] and waits == [1, 2]

    def spent(texts):
        raise QuotaExhausted
    waits.clear()
    with pytest.raises(QuotaExhausted):
        with_retry(spent, ["a"], waits.append)
    assert waits == []

    df = spark.createDataFrame([("a",), (None,)], "text string")
    assert rows(embed(df, "text", lambda ts: [[float(len(t)), 0.0] for t in ts], 2), "embedding") == [[0.0, 0.0], [1.0, 0.0]]
    with pytest.raises(Exception, match="2 numbers"):
        embed(df, "text", lambda ts: [[1.0] for _ in ts], 2).collect()


def test_add_texts_keeps_given_ids(spark):
    df = spark.createDataFrame([("x", "hello"), (None, "world")], "id string, text string")
    got = {r["text"]: r for r in add_texts(df, dims=8).collect()}
    assert got["hello"]["id"] == "x" and len(got["world"]["id"]) == 64 and len(got["world"]["embedding"]) == 8


@pytest.fixture(scope="module")
def notes(spark):
    """Texts of very different lengths over frequent and rare words, in file order by topic; some repeated, empty or null."""
    rng = np.random.default_rng(11)
    common, data = [f"c{i}" for i in range(12)], []
    for topic in range(30):
        rare = [f"t{topic}x{j}" for j in range(6)]
        for _ in range(60):
            n = int(rng.integers(1, 50))
            words = rng.choice(common + rare, n, p=[0.06] * 12 + [0.28 / 6] * 6)
            data.append((len(data), " ".join(words), str(rng.choice(["Harbour", "north pier"]))))
    data += [(len(data) + i, t, "Harbour") for i, t in enumerate([None, "", "--", data[5][1], data[5][1], "C1 c1 C1"])]
    return spark.createDataFrame(data, "id long, text string, place string").repartitionByRange(3, "id").cache()


@pytest.fixture(scope="module")
def searches(spark):
    data = [("rare", "t3x1 t3x2 t3x1"), ("mixed", "c1 t7x0"), ("common", "c1 c2 c3 c4"), ("place", "north t1x1"), ("none", "unheard of"), ("empty", ""), (None, "c5 t9x1")]
    return spark.createDataFrame(data, "query_id string, text string")


@pytest.mark.parametrize("fields", [["text"], ["text", "place"]])
def test_block_search_equals_scoring_every_match(spark, notes, searches, tmp_path, fields):
    whole = text_search.bm25_topk(searches, text_search.build_text_index(notes, fields), 10, fields=fields).collect()
    text_search.build_block_index(notes, fields).save(str(tmp_path / "ix"), files=3)
    index = text_search.BlockIndex.load(spark, str(tmp_path / "ix"))
    assert sorted(map(tuple, text_search.bm25_topk(searches, index, 10, fields=fields).collect()), key=str) == sorted(map(tuple, whole), key=str)
    scanned = text_search.bm25_topk(searches, notes, 10, fields=fields).collect()
    assert sorted(map(tuple, scanned), key=str) == sorted(map(tuple, whole), key=str)
    assert rows(text_search.bm25_topk(searches, index, None, fields=fields), "query_id", "id", "score") == rows(text_search.bm25_topk(searches, notes, None, fields=fields), "query_id", "id", "score")


def test_block_search_opens_few_blocks(spark, notes, searches, monkeypatch):
    monkeypatch.setattr(text_search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(text_search, "FIRST_BLOCKS", 2)
    built = text_search.build_block_index(notes, ["text"])
    index = text_search.BlockIndex(built.blocks.cache(), built.stats, built.fields)
    opened = []
    assert text_search.pruned_topk(searches, index, 5, opened=opened).count() > 0
    terms = text_search.query_terms(searches)
    postings = lambda pairs: dict(pairs.join(terms, "query_id").join(index.blocks, ["term", "block"]).groupBy("query_id").agg(F.sum("df")).collect())
    held = index.blocks.join(terms, "term").select("query_id", "block").distinct()
    read, there = postings(opened[0].unionByName(opened[1])), postings(held)
    # A rare word beside a frequent one leaves most of the frequent one's postings unread; frequent words alone do not.
    assert read["mixed"] < 0.25 * there["mixed"] and sum(read.values()) < sum(there.values())
    assert opened[0].join(opened[1], ["query_id", "block"]).isEmpty()  # none is opened twice


def test_block_search_filters_before_the_limit(spark, notes, searches):
    keep = text_search.matching_ids(notes, F.col("id") % 7 == 3)
    index = text_search.build_block_index(notes, ["text"])
    index = text_search.BlockIndex(index.blocks.cache(), index.stats, index.fields)
    assert rows(text_search.bm25_topk(searches, index, 6, keep_ids=keep)) == rows(text_search.bm25_topk(searches, notes, 6, keep_ids=keep))


def test_scan_in_small_steps_equals_the_index(spark, notes, searches, monkeypatch):
    from mnemospark.operators import text_scan
    want = rows(text_search.bm25_topk(searches, text_search.build_text_index(notes, ["text"]), 7))
    ranked = text_scan.Ranked(1, 2)
    for ids, scores in (([5, 3], [1.0, 1.0]), ([9, None, 1], [0.0, 1.0, 0.5]), ([4], [2.0])):
        ranked.add(np.array([scores]), ids)
    assert [(i, -s) for s, _, i in ranked.hits[0]] == [(4, 2.0), (None, 1.0)]
    assert rows(text_search.bm25_topk(searches, notes, 7)) == want
    assert text_search.bm25_topk(searches, notes.limit(0), 7).count() == 0
    assert text_search.bm25_topk(searches.limit(0), notes, 7).count() == 0


def test_counting_words_moves_nothing(spark, notes):
    plan = text_search.build_text_index(notes, ["text"]).postings._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryTableScan")[0]
    counted = text_search.build_text_index(notes, ["text"]).postings.filter("term = 'c1' AND id > 1800").collect()
    assert {(r.id, r.tf, r.doc_len) for r in counted} >= {(1805, 3, 3)}


def test_block_search_moves_no_pair_of_query_and_document(spark, notes, searches, monkeypatch):
    """Only the first blocks are opened by joins; the rest is scored where a block's postings lie, across batches too."""
    monkeypatch.setattr(text_search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(text_search, "FIRST_BLOCKS", 1)
    opened_by_join, real = [], text_search._open

    def counted(pairs, *more):
        opened_by_join.append(pairs.select("query_id", "block").distinct().count())
        return real(pairs, *more)

    built = text_search.build_block_index(notes, ["text"])
    index = text_search.BlockIndex(built.blocks.cache(), built.stats, built.fields)
    want = rows(text_search.bm25_topk(searches, text_search.build_text_index(notes, ["text"]), 30))
    monkeypatch.setattr(text_search, "_open", counted)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows(text_search.bm25_topk(searches, index, 30)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(opened_by_join) <= searches.count()
    assert text_search.bm25_topk(searches.limit(0), index, 5).count() == 0

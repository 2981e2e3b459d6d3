"""Ranked search against scoring every document."""

import math
import random

import numpy as np
import pytest

from mnemospark.llm import lexical
from mnemospark.llm.lexical import Block
from mnemospark.llm.license_scan import words_of


def plain(docs, items, k=10):
    words = [(i, words_of(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, n_terms = len(words), sum(len(w) for _, w in words)
    held = [(i, w, {t: w.count(t) for t in set(w)}) for i, w in words]
    df = {}
    for _, _, counts in held:
        for t in counts:
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, w, counts in held:
            m = 10 + 90 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1))) * (1000000000 * counts[t] // (1000 * counts[t] + 8 * m)) for t in set(words_of(text)) if t in counts)
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0))
        out += [(item, r, None if gone else i, -s) for r, (s, gone, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.fixture
def drawn():
    rng = random.Random(3)
    vocabulary = ["the", "of", "é", "日本"] + [f"w{i}" for i in range(90)]
    text = lambda n: " ".join(rng.choices(vocabulary, weights=[30, 20, 9, 9] + [90 / (i + 1) for i in range(90)], k=n))
    docs = [(i, text(rng.choice([0, 1, 3, 20, 60])), "en", "s") for i in range(300)]
    docs += [(i % 5, docs[7][1] + " w1", "en", "s") for i in range(8)] + [(None, docs[7][1] + " w1", "en", "s")]
    items = [(i, text(n)) for i, n in enumerate([0, 1, 2, 5, 20, 40, 400])] + [(3, "THE of"), (3, "THE of"), (None, "w1 w2"), (8, None), (9, "unknown"), (10, " ".join(vocabulary))]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_scoring_all(spark, docs, drawn, rough, monkeypatch, small):
    if small:  # several blocks, several parts of items
        monkeypatch.setattr(lexical, "PART_TERMS", 30)
        monkeypatch.setattr(lexical, "BLOCK_DOCS", 40)
    rows, items = drawn
    rows = rows + [(1000 + (i or 0), t, a, b) for i, t, a, b in rough]
    df = docs(rows).withColumnsRenamed({"words": "score", "class": "rank"}).repartition(3)
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    assert found(lexical.search(df, table)) == plain([(i, t) for i, t, _, _ in rows], items)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs([]), items).count() == 0
    assert lexical.search(docs([(1, "a", "en", "s")]), items.where("item_id > 1")).count() == 0


def test_masks_beyond_reach_are_not_scored():
    rng = np.random.default_rng(5)
    n, k = 4000, 150  # masks of three columns
    there = rng.random((k, n)) < np.linspace(0.02, 0.5, k)[:, None]
    there[:, :12] = True
    held = there.sum(axis=1)
    docs = np.concatenate([np.flatnonzero(row) for row in there]).astype(np.int32)
    tf = rng.integers(1, 4, len(docs))
    lengths = rng.integers(50, 400, n)
    block = Block(np.arange(k, dtype=np.int32), held, docs, tf, lengths, rng.integers(100, 9000, k), n, int(lengths.sum()))
    masks = block.masks(list(range(k)))
    assert all(((int(masks[d, t // 64]) >> (t % 64)) & 1) == there[t, d] for t in range(0, k, 7) for d in range(0, n, 97))
    got = block.best(np.arange(k), list(range(n)), [], 10)
    assert block.scored < n / 10
    exact = block.scores(np.arange(n), list(range(k)))
    assert [(-s, d) for s, _, d in got] == sorted([(int(s), d) for d, s in enumerate(exact)], key=lambda x: (-x[0], x[1]))[:10]


def test_long_lengths_stay_exact():
    lengths = np.array([10 ** 12, 5])
    block = Block(np.array([0]), np.array([2]), np.array([0, 1], np.int32), np.array([1, 2]), lengths, np.array([1000]), 10 ** 8, 10 ** 14)
    m = [10 + 90 * int(n) * 10 ** 8 // 10 ** 14 for n in lengths]
    assert block.parts.tolist() == [1000 * (10 ** 9 * t // (1000 * t + 8 * x)) for t, x in zip([1, 2], m)]

"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Features are words and word beginnings of 4 to 6 letters. Those that toxic training texts hold far
more often than others (a likelihood ratio test) form the lexicons; they are dealt by their first letters to
``VOTERS`` lexicon voters, so that forms of one word share a voter. Pattern voters see a fixed word list,
several hits, and hits from several lexicons. The label model is a latent class model of the votes:
expectation maximisation gives each voter's hit rate for toxic and other texts, correlations of the
votes within the classes lower the weight of voters that repeat each other, and the model is fitted again.
Its posterior labels and the given ones, with half of the say each, train a logistic regression on the features:
which of the loosely chosen features speak for toxicity is up to its weights.

``FIT_ROWS`` bounds the labelled rows that take part, chosen by a hash of their ids; the texts of these
are read by joining with their ids, a table of that bound. Only words decide: label, language, source and id
are no inputs. Null and empty texts get the score of a text without features. Rows of one id
with several labels count as toxic if one says so; null labels and ids do not train. Equal texts get equal
scores. Without toxic training rows there are no features and every score is that of the prior.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.llm import shingles
from mnemospark.llm.staging import stage, unit

FIT_ROWS = 20_000
MOST_FEATURES = 4096
LEAST_TEXTS, LEAST_RATIO, LEAST_EVIDENCE = 3, 8.0, 30.0
VOTERS = 16
DECAY = 1e-4  # of the classifier's weights
LEASTS = 4  # hashes by which copies are told
TOKEN = re.compile(r"[^\W\d_]+")
STARTS = (4, 5, 6)
INSULTS = frozenset("idiot moron stupid scum trash worthless pathetic loser disgusting clown".split())  # a plain list of insults


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; null ids are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def features(text: str) -> set[str]:
    """Words (``=word``) and word beginnings of a text, in lower case."""
    words = set(TOKEN.findall(text.lower()))
    found = {"=" + w for w in words}
    for size in STARTS:
        found.update(w[:size] for w in words if len(w) >= size)
    return found


@dataclass
class Classifier:
    names: dict[str, int]
    weights: np.ndarray
    bias: float
    accuracy: np.ndarray | None = None  # of voters: hit rates for (toxic, other)
    correlation: np.ndarray | None = None

    def score(self, texts: list[str]) -> list[float]:
        heads = {n.lstrip("=")[:STARTS[0]] for n in self.names}
        out, names, weights = [], self.names, self.weights
        for text in texts:
            total = self.bias
            hits = set()
            for w in set(TOKEN.findall(text.lower())):
                if w[:STARTS[0]] in heads:
                    hits.update(i for f in ("=" + w, *(w[:s] for s in STARTS if len(w) >= s)) if (i := names.get(f)) is not None)
            total += float(weights[sorted(hits)].sum()) if hits else 0.0
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
        return out


def label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the latent class for each row of votes, hit rates (2, voters), correlations.

    A voter fires (1) or abstains (0). Expectation maximisation starts from the ``known`` labels, which keep
    half of the say in the rates, so that the classes cannot change their meaning. That all abstain is
    a vote as well. Voters correlated within the classes are weighed down and the model is fitted again.
    """
    votes = np.hstack([votes, 1 - votes.max(1, keepdims=True)])
    n, m = votes.shape
    weight, corr = np.ones(m), np.eye(m)
    post = known.astype(float)
    rates = np.zeros((2, m))
    for turn in range(2):
        for _ in range(rounds):
            share = (post + known) / 2
            prior = np.clip(share.mean(), 1e-4, 1 - 1e-4)
            rates = np.stack([(share @ votes + 0.5) / (share.sum() + 1), ((1 - share) @ votes + 0.5) / (n - share.sum() + 1)])
            post = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + votes @ (weight * np.log(rates[0] / rates[1])), -30, 30)))
        if turn == 0:
            rest = votes - (post[:, None] * rates[0] + (1 - post[:, None]) * rates[1])
            cov = rest.T @ rest / max(1, n)
            spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = cov / spread[:, None] / spread
            weight = 1 / (1 + np.abs(corr - np.diag(np.diag(corr))).max(1))  # a twin halves the say
    return post, rates, corr


def regression(rows: list[np.ndarray], target: np.ndarray, size: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features and soft labels, by Adam on all rows."""
    where = np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, first, second = (np.zeros(size + 1) for _ in range(3))
    w[-1] = -2.0
    for n in range(1, rounds + 1):
        z = np.bincount(owner, w[where], minlength=len(rows)) + w[-1]
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        grad = np.append(np.bincount(where, err[owner], minlength=size), err.sum()) / max(1, len(rows)) + DECAY * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad ** 2
        w = w - 0.1 * first / (1 - 0.9 ** n) / (np.sqrt(second / (1 - 0.99 ** n)) + 1e-9)
    return w[:-1], float(w[-1])


def voter_of(feature: str, voters: int = VOTERS) -> int:
    head = feature.lstrip("=")[:STARTS[0]]
    return sum(ord(c) * 31 ** i for i, c in enumerate(head)) % voters


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", key: str = "doc_id", label_col: str = "toxic", rows: int = FIT_ROWS) -> Classifier:
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(F.col(key))).groupBy(F.col(key).alias("k")).agg(F.max(label_col).cast("int").alias("toxic"))
    share = rows / max(1, known.count())
    # At most about FIT_ROWS rows of two numbers.
    chosen = F.broadcast(known.where(unit("k", seed=8) < share))
    rows_of = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, "k")

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8") for t in batch.column("text").to_pylist()]
            values, counts = shingles.runs(*shingles.words(texts), 5)
            parts = np.split(values, np.cumsum(counts)[:-1])
            least = [[int(shingles.mix(p + np.uint64(j)).min()) >> 1 if len(p) else -1 for j in range(LEASTS)] for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("toxic"), pa.array(least, pa.list_(pa.int64()))], ["k", "toxic", "least"])

    # Copies of a text would make all its words look toxic: a row stays if no row with a smaller id shares one of
    # its smallest shingles by several hashes.
    marked = stage(rows_of.select(F.col("k").cast("long").alias("k"), "text", "toxic").mapInArrow(least, "k long, toxic int, least array<long>"), "toxic-rows")
    slots = marked.select("k", F.posexplode("least").alias("slot", "h"))
    beaten = slots.join(slots.groupBy("slot", "h").agg(F.min("k").alias("first")), ["slot", "h"]).where("k > first").select("k").distinct()
    single = stage(marked.join(beaten, "k", "left_anti").select("k", "toxic"), "toxic-single")
    texts = rows_of.select("k", "text").join(F.broadcast(single), "k").select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update(features(text))
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()), pa.array([seen[0][f] for f in names], pa.int64())], ["f", "pos", "neg"])

    totals = texts.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_pos, n_neg = int(totals[0] or 0), int(totals[1]) - int(totals[0] or 0)
    if not n_pos or not n_neg:
        return Classifier({}, np.zeros(0), math.log((n_pos + 0.5) / (n_neg + 0.5)))
    counted = texts.mapInArrow(count, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    pos, neg, base = F.col("pos"), F.col("neg"), n_pos / (n_pos + n_neg)
    ratio = (pos + 0.5) / (n_pos + 1) / ((neg + 0.5) / (n_neg + 1))
    share_pos = pos / (pos + neg)
    part = lambda n, p, q: F.when(n > 0, n * F.log(p / F.lit(q))).otherwise(0.0)
    evidence = 2 * (part(pos, share_pos, base) + part(neg, 1 - share_pos, 1 - base))
    strong = counted.where((pos >= LEAST_TEXTS) & (ratio >= LEAST_RATIO)).withColumn("g", evidence).where(F.col("g") >= LEAST_EVIDENCE)
    names = {r["f"]: i for i, r in enumerate(strong.orderBy(F.desc("g"), "f").limit(MOST_FEATURES).collect())}

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(names[f] for f in features(t) if f in names) for t in batch.column("text").to_pylist()]
            insults = [len(INSULTS & set(TOKEN.findall(t.lower()))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(insults, pa.int32()), batch.column("toxic")], ["hits", "insults", "toxic"])

    got = texts.mapInArrow(hits, "hits array<int>, insults int, toxic int").collect()  # about FIT_ROWS short rows
    found = sorted((tuple(r["hits"]), r["insults"], r["toxic"]) for r in got)  # in an order that tasks do not change
    rows_ = [np.array(h, np.int64) for h, _, _ in found]
    group = np.array([voter_of(f) for f in names] or [0])
    votes = np.zeros((len(found), VOTERS + 4))
    for i, (h, (_, insults, _)) in enumerate(zip(rows_, found)):
        if len(h):
            votes[i, group[h]] = 1
        votes[i, VOTERS:] = (insults > 0, insults > 1, len(h) > 2, votes[i, :VOTERS].sum() > 1)
    known = np.array([t for _, _, t in found])
    post, rates, corr = label_model(votes, known)
    weights, bias = regression(rows_, (post + known) / 2, len(names))
    return Classifier(names, weights, bias, rates, corr)


def scored(text: Column, model: Classifier) -> Column:
    """Score of a text from 0 to 1."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list[float] = []
            for start in range(0, len(batch), 256):
                out += model.score([t or "" for t in batch.slice(start, 256).to_pylist()])
            yield pa.array(out, pa.float64())

    return F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR_ITER)(F.coalesce(text, F.lit("")))


def judge(docs: DataFrame, model: Classifier, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """A row per row of ``docs``: key, held_out, score, predicted."""
    return docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), scored(F.col(text_col), model).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Ranked lexical search by groups of matched-term masks.

Each block of documents keeps the postings of the items' terms. For an item, the bitmaps of its terms are laid over one
another, so that each document has a mask of the terms it holds; documents of one mask form a group. The best that a
group could score is the sum of its terms' largest parts in the block. Groups are scored in descending order of that
bound until none left can reach the item's best ``k``, so the result equals scoring every document.

Terms are letters, digits and all that is not ASCII, A to Z in lower case. Null and empty texts have no terms: such
documents count nowhere and such items have no rows. Every row is a document or an item of its own, also where ids are
repeated; null ids stand last among equal scores. Extra columns play no part. Empty tables give an empty result.

Documents are spread by Spark and read twice in narrow stages: once as texts, once as postings. Items travel to the tasks
in parts of at most ``PART_TERMS`` terms; further parts are further passes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from mnemospark.llm.license_scan import words_of
from mnemospark.llm.staging import stage

PART_TERMS = 1_000_000  # terms of the items that travel to the tasks at once; one item with more makes a part of its own
BLOCK_DOCS = 16_384  # documents of a block, at most
BLOCK_POSTINGS = 2_000_000  # postings after which a block ends
FIRST_GROUPS = 64  # documents scored before the bound is tried for the first time; doubles each time
SALTS = 1000  # keys over which the tasks' best rows of one item are spread before they meet


class Block:
    """Postings of a block in term order, with each posting's part of the score."""

    def __init__(self, terms, held, docs, tf, lengths, weights, n_docs: int, n_terms: int):
        self.size = len(lengths)
        ends = np.cumsum(held)
        self.span = {t: (a, b) for t, a, b in zip(terms.tolist(), (ends - held).tolist(), ends.tolist())}
        self.docs = docs
        if 90 * int(lengths.max(initial=0)) * n_docs < 1 << 63:
            m = 10 + 90 * lengths * n_docs // n_terms
        else:  # the product leaves 64 bits, the quotient does not
            m = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        self.parts = np.repeat(weights[terms], held) * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
        self.most = dict(zip(terms.tolist(), np.maximum.reduceat(self.parts, ends - held).tolist())) if len(terms) else {}
        self.bitmaps: dict[int, np.ndarray] = {}
        self.scored = 0  # documents whose score has been computed

    def bitmap(self, term: int) -> np.ndarray:
        """Packed bits of the documents that hold a term; those of common terms are kept."""
        if (bits := self.bitmaps.get(term)) is None:
            a, b = self.span[term]
            there = np.zeros(self.size, np.uint8)
            there[self.docs[a:b]] = 1
            bits = np.packbits(there)
            if 16 * (b - a) >= self.size:
                self.bitmaps[term] = bits
        return bits

    def masks(self, terms: list[int]) -> np.ndarray:
        """For each document the mask of the terms it holds, 64 terms to a column."""
        columns = []
        for start in range(0, len(terms), 64):
            bits = np.unpackbits(np.stack([self.bitmap(t) for t in terms[start:start + 64]]), axis=1, count=self.size)
            packed = np.zeros((self.size, 8), np.uint8)
            rows = np.packbits(bits, axis=0, bitorder="little")
            packed[:, :len(rows)] = rows.T
            columns.append(packed.view(np.uint64)[:, 0])
        return np.stack(columns, axis=1)

    def groups(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents in order of their masks, where each mask begins, and the most that each mask could score."""
        masks = self.masks(terms)
        group = np.zeros(self.size, np.int64)
        for column in range(masks.shape[1]):
            values, of = np.unique(masks[:, column], return_inverse=True)
            if column:
                _, group = np.unique(group * len(values) + of, return_inverse=True)
            else:
                group = of
        order = np.argsort(group, kind="stable")
        begins = np.flatnonzero(np.diff(group[order], prepend=-1))
        octets = np.ascontiguousarray(masks[order[begins]]).view(np.uint8)
        most = np.zeros(8 * octets.shape[1], np.int64)
        most[:len(terms)] = [self.most[t] for t in terms]
        # What each octet of a mask could score, for all 256 octets.
        sums = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64) @ most.reshape(-1, 8).T
        bounds = sums[octets, np.arange(octets.shape[1])].sum(axis=1)
        return order, begins, bounds

    def scores(self, docs: np.ndarray, terms: list[int]) -> np.ndarray:
        """Exact scores of some documents."""
        out = np.zeros(len(docs), np.int64)
        self.scored += len(docs)
        for t in terms:
            a, b = self.span[t]
            holders = self.docs[a:b]
            at = np.searchsorted(holders, docs)
            at[at == b - a] = 0
            out += np.where(holders[at] == docs, self.parts[a + at], 0)
        return out

    def best(self, terms: np.ndarray, ids: list, found: list[tuple], k: int) -> list[tuple]:
        """``found`` and the documents of this block: the best ``k`` as (-score, id is null, id), in order."""
        terms = [t for t in terms.tolist() if t in self.span]
        if not terms:
            return found
        order, begins, bounds = self.groups(terms)
        ends = np.append(begins[1:], self.size)
        ranked = np.argsort(-bounds, kind="stable")
        taken, at, room = np.cumsum((ends - begins)[ranked]), 0, FIRST_GROUPS
        while at < len(ranked):
            least = -found[-1][0] if len(found) == k else 1
            if bounds[ranked[at]] < least:
                break
            done = int(taken[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(taken, done + room, "right")))
            upto = min(upto, int(np.searchsorted(-bounds[ranked], -least, "right")))
            docs = np.concatenate([order[begins[g]:ends[g]] for g in ranked[at:upto].tolist()])
            scores = self.scores(docs, terms)
            good = np.flatnonzero(scores >= least)
            if len(good) > k:  # ties with the k-th stay
                good = good[scores[good] >= -np.partition(-scores[good], k - 1)[k - 1]]
            found = sorted(found + [(-s, ids[d] is None, ids[d]) for s, d in zip(scores[good].tolist(), docs[good].tolist())], key=_order)[:k]
            at, room = upto, 2 * room
        return found


def _order(hit: tuple) -> tuple:
    return hit if not hit[1] else hit[:2]


def _field(df: DataFrame, column: str):
    return df.select(F.col(column)).schema[0].dataType


def postings(docs: DataFrame, terms, doc_id: str, text: str) -> DataFrame:
    """Blocks of documents with the postings of some terms; ``terms`` is a broadcast of term to number."""
    kind = _field(docs, doc_id)
    schema = StructType([StructField("n_docs", LongType()), StructField("n_terms", LongType()), StructField("ids", ArrayType(kind)),
                         *[StructField(c, ArrayType(LongType())) for c in ("lengths",)],
                         *[StructField(c, ArrayType(IntegerType())) for c in ("terms", "held", "docs", "tf")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = terms.value
        asked = number.keys()
        n_docs = n_terms = 0
        ids, lengths, rows, all_terms, all_tf = [], [], [], [], []
        arrow = None

        def block() -> pa.RecordBatch:
            t = np.array(all_terms, np.int32)
            order = np.argsort(t, kind="stable")
            docs_ = np.repeat(np.arange(len(rows), dtype=np.int32), rows)[order]
            distinct, held = np.unique(t, return_counts=True)
            row = {"n_docs": n_docs, "n_terms": n_terms, "ids": pa.array(ids, arrow), "lengths": lengths, "terms": distinct,
                   "held": held, "docs": docs_, "tf": np.array(all_tf, np.int32)[order]}
            lists = {"ids": arrow, "lengths": pa.int64(), "terms": pa.int32(), "held": pa.int32(), "docs": pa.int32(), "tf": pa.int32()}
            return pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, lists[c])) if c in lists else pa.array([v], pa.int64()) for c, v in row.items()], list(row))

        for batch in batches:
            arrow = batch.column(0).type
            for i, value in zip(batch.column(0), batch.column(1)):
                words = words_of(value.as_py())
                if not words:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(words)
                counts = Counter(words)
                if hits := list(counts.keys() & asked):
                    ids.append(i.as_py())
                    lengths.append(len(words))
                    rows.append(len(hits))
                    all_terms += map(number.__getitem__, hits)
                    all_tf += map(counts.__getitem__, hits)
                    if len(ids) >= BLOCK_DOCS or len(all_tf) >= BLOCK_POSTINGS:
                        yield block()
                        n_docs = n_terms = 0
                        ids, lengths, rows, all_terms, all_tf = [], [], [], [], []
        if n_docs:
            yield block()

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, schema)


def _parts(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Items with terms, as (number, id, distinct terms), in parts; the driver holds one part at a time."""
    part, size = [], 0
    for n, row in enumerate(items.select(F.col(item_id), F.col(text).cast("string")).toLocalIterator()):
        if terms := sorted(set(words_of(row[1]))):
            if part and size + len(terms) > PART_TERMS:
                yield part
                part, size = [], 0
            part.append((n, row[0], terms))
            size += len(terms)
    if part:
        yield part


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents with the highest score above 0 for each item."""
    spark = docs.sparkSession
    id_kind, item_kind = _field(docs, doc_id), _field(items, item_id)
    schema = StructType([StructField("item_no", LongType()), StructField("item_id", item_kind), StructField("doc_id", id_kind), StructField("score", LongType())])
    found = [_search_part(docs, part, k, schema, doc_id, text) for part in _parts(items, item_id, item_text)]
    hits = spark.createDataFrame([], schema)
    for part in found:
        hits = hits.unionByName(part)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # First among the rows of some tasks, then among what these have left, so that an item's rows never meet all at once.
    some = Window.partitionBy("item_no", "salt").orderBy(*best)
    whole = Window.partitionBy("item_no").orderBy(*best)
    fewer = hits.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    return fewer.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_part(docs: DataFrame, part: list[tuple], k: int, schema: StructType, doc_id: str, text: str) -> DataFrame:
    """Each task's best rows for the items of one part."""
    spark = docs.sparkSession
    number = {t: n for n, t in enumerate(sorted({t for _, _, terms in part for t in terms}))}
    asked = [(n, i, np.array([number[t] for t in terms], np.int32)) for n, i, terms in part]
    blocks = stage(postings(docs, spark.sparkContext.broadcast(number), doc_id, text), "postings")
    sizes = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = sizes[0] or 0, sizes[1] or 0
    weights = np.zeros(len(number), np.int64)
    # One row per term of the part.
    for row in blocks.select(F.explode(F.arrays_zip("terms", "held")).alias("t")).groupBy("t.terms").agg(F.sum("t.held").alias("df")).toLocalIterator():
        weights[row[0]] = math.floor(1000 * math.log((2.0 * n_docs + 2.0) / (2.0 * row[1] + 1.0)))
    given = spark.sparkContext.broadcast((asked, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = given.value
        found: list[list[tuple]] = [[] for _ in asked]
        kinds = None
        for batch in batches:
            kinds = batch.schema
            for r in range(batch.num_rows):
                column = {c: batch.column(c)[r].values for c in batch.schema.names if c not in ("n_docs", "n_terms")}
                values = {c: v.to_numpy(zero_copy_only=False) for c, v in column.items() if c != "ids"}
                ids = column["ids"].to_pylist()
                block = Block(values["terms"], values["held"], values["docs"], values["tf"].astype(np.int64), values["lengths"], weights, n_docs, n_terms)
                for j, (_, _, terms) in enumerate(asked):
                    found[j] = block.best(terms, ids, found[j], k)
        rows = [(n, i, d, -s) for (n, i, _), hits in zip(asked, found) for s, _, d in hits]
        if rows:
            names = [f.name for f in schema]
            types = [pa.int64(), None, kinds.field("ids").type.value_type, pa.int64()]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
            yield pa.record_batch(columns, names)

    return blocks.where(F.size("ids") > 0).mapInArrow(run, schema)


SQL = r"""
WITH held AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sums AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM held),
asked AS (SELECT DISTINCT i, item_id, term FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
counted AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM held) SEMI JOIN (SELECT term FROM asked) USING (term) GROUP BY r, term),
weighed AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), sums),
sized AS (SELECT r, doc_id, 10 + (90 * len(w)::BIGINT * n_docs) // n_terms AS m FROM held, sums WHERE len(w) > 0),
scored AS (SELECT i, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN counted USING (term) JOIN sized USING (r) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0) WHERE rank <= 10"""

"""Text search over a table without an index: one pass counts, one pass ranks, no pair of query and document moves.

Each task turns its texts into blocks of postings of the asked terms. Document frequencies are summed over the blocks;
then each task scores its blocks against all queries and keeps the best ``k`` per query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from mnemospark.functions.text import distinct_tokens, tokens
from mnemospark.operators.ranking import SCORE_DIGITS, top_k
from mnemospark.session import durable

BLOCK_DOCS = 4096  # documents of a block
CELLS = 8_000_000  # most scores, or gains, that are held at once
LISTS = {"ids": None, "kept": None, "lens": pa.int32(), "codes": pa.int32(), "held": pa.int32(), "docs": pa.int32(), "tf": pa.int32(), "n_docs": pa.int64(), "n_words": pa.int64()}


def asked_terms(queries: DataFrame, bound: int, query_id: str = "query_id", text: str = "text") -> list[tuple] | None:
    """``(query_id, term)`` of all queries, or ``None`` if there are more than ``bound``."""
    rows = queries.select(F.col(query_id), F.explode(distinct_tokens(text))).limit(bound + 1).collect()
    return None if len(rows) > bound else [tuple(r) for r in rows]


def _blocks(corpus: DataFrame, fields: Sequence[str], id_col: str, terms: pa.Array, within: Column | None) -> DataFrame:
    """Blocks of postings; ``codes`` are ``field * number of terms + term``, in order, with ``held`` postings each.

    Rows that are not ``kept`` count in the statistics only.
    """
    n, width = len(fields), len(terms)
    rows = corpus.select(F.col(id_col).alias("id"), *[tokens(F.col(f"`{f}`").cast("string")).alias(f"_{i}") for i, f in enumerate(fields)],
                         F.coalesce(F.lit(True) if within is None else within, F.lit(False)).alias("_kept"))
    kinds = {"ids": rows.schema["id"].dataType, "kept": BooleanType(), "n_docs": LongType(), "n_words": LongType()}
    schema = StructType([StructField(c, ArrayType(kinds.get(c, IntegerType()))) for c in LISTS])
    given = corpus.sparkSession.sparkContext.broadcast(terms)

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        size, codes, docs, lens, n_words, n_docs = batch.num_rows, [], [], [], [], []
        for i in range(n):
            column = batch.column(1 + i)
            of = pc.list_parent_indices(column).to_numpy()
            found = pc.index_in(pc.list_flatten(column), value_set=given.value)
            here = found.is_valid().to_numpy(zero_copy_only=False)
            each = np.bincount(of, minlength=size)
            codes.append(found.drop_null().to_numpy().astype(np.int64) + i * width)
            docs.append(of[here])
            lens.append(each)
            n_words.append(int(each.sum()))
            n_docs.append(int((each > 0).sum()))
        pairs, tf = np.unique(np.concatenate(codes) * size + np.concatenate(docs), return_counts=True)
        distinct, held = np.unique(pairs // size, return_counts=True)
        values = {"ids": batch.column(0), "kept": batch.column(1 + n), "lens": np.concatenate(lens), "codes": distinct, "held": held, "docs": pairs % size, "tf": tf, "n_docs": n_docs, "n_words": n_words}
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if kind is None else pa.array(np.asarray(v), kind)) for (c, kind), v in zip(LISTS.items(), values.values())]
        return pa.record_batch(lists, list(LISTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_DOCS):
                yield block(batch.slice(start, BLOCK_DOCS))

    return durable(rows.mapInArrow(run, schema))


class Ranked:
    """The best ``k`` documents of each query so far, by rounded score and then id."""

    def __init__(self, queries: int, k: int):
        self.k, self.hits, self.floor = k, [[] for _ in range(queries)], np.zeros(queries)

    def add(self, scores: np.ndarray, ids: list, asking: np.ndarray | None = None) -> None:
        """Scores of some documents, a row per query or per query of ``asking``; 0 is no match."""
        matches, scores = scores > 0, np.round(scores, SCORE_DIGITS)
        least = self.floor if asking is None else self.floor[asking]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        query, doc = np.nonzero((scores >= least[:, None]) & matches)
        found: dict[int, list] = {}
        for q, s, d in zip((query if asking is None else asking[query]).tolist(), scores[query, doc].tolist(), doc.tolist()):
            found.setdefault(q, []).append((-s, ids[d] is not None, ids[d]))  # a null id comes first, as in an ascending order
        for q, fresh in found.items():
            self.hits[q] = hits = sorted(self.hits[q] + fresh, key=lambda h: h if h[1] else h[:2])[:self.k]
            if len(hits) == self.k:
                self.floor[q] = -hits[-1][0]


def scan_topk(asked: list[tuple], queries: DataFrame, corpus: DataFrame, k: int, fields: Sequence[str], id_col: str, query_id: str,
              idf, part, within: Column | None = None, also: list[tuple] | None = None) -> DataFrame:
    """``(query_id, id, rank, score)`` of the first ``k`` for the ``asked`` (query, term) pairs.

    ``idf(n_docs, df)`` and ``part(tf, doc_len, avg_len)`` work on numpy arrays. Only documents ``within`` are ranked; the
    statistics are those of all. Of ``also``, pairs of query and id, those that match come with their rank, whatever it is.
    """
    spark = corpus.sparkSession
    names = list(dict.fromkeys(q for q, _ in asked))
    terms = sorted({t for _, t in asked})
    number, place = {q: i for i, q in enumerate(names)}, {t: i for i, t in enumerate(terms)}
    blocks = _blocks(corpus, fields, id_col, pa.array(terms, pa.string()), within)
    width, n = len(terms), len(fields)
    sums = blocks.agg(*[F.sum(F.col(c)[i]).alias(f"{c}_{i}") for c in ("n_docs", "n_words") for i in range(n)]).first()
    n_docs, n_words = (np.array([sums[f"{c}_{i}"] or 0 for i in range(n)], float) for c in ("n_docs", "n_words"))
    df = np.zeros(n * width)
    for row in blocks.select(F.explode(F.arrays_zip("codes", "held")).alias("p")).groupBy("p.codes").agg(F.sum("p.held").alias("df")).toLocalIterator():
        df[row[0]] = row[1]  # at most one row per field and asked term
    rarity, average = idf(np.repeat(n_docs, width), df), n_words / np.maximum(n_docs, 1)
    pairs = sorted((place[t], number[q]) for q, t in asked)
    of_term = np.array([q for _, q in pairs], np.int64)
    count = np.bincount([t for t, _ in pairs], minlength=width)
    given = spark.sparkContext.broadcast((rarity, average, of_term, count))
    kind = corpus.select(F.col(id_col)).schema[0].dataType
    schema = StructType([StructField("_q", IntegerType()), StructField("id", kind), StructField("score", DoubleType()), StructField("also", BooleanType())])

    wanted: dict = {}  # queries that ask for the place of a document
    for q, i in also or []:
        if q in number and i is not None:
            wanted.setdefault(i, []).append(number[q])
    sought = spark.sparkContext.broadcast(wanted)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, list, np.ndarray]]:
        """Some documents at a time: the type of their ids, the ids, and their scores, a row per query."""
        rarity, average, of_term, count = given.value
        firsts = np.cumsum(count) - count
        for batch in batches:
            arrow = batch.schema.field("ids").type.value_type
            for r in range(batch.num_rows):
                of = {c: batch.column(c)[r].values for c in LISTS}
                ids = of["ids"].to_pylist()
                codes, held, docs, tf, lens = (of[c].to_numpy() for c in ("codes", "held", "docs", "tf", "lens"))
                codes, size = np.repeat(codes, held), len(ids)
                kept = of["kept"].to_numpy(zero_copy_only=False)[docs]
                codes, docs, tf = codes[kept], docs[kept], tf[kept]
                field = codes // width if width else codes
                gain = rarity[codes] * part(tf, lens[field * size + docs], average[field])
                term = codes - field * width
                # Documents at a time, so that neither the scores nor the gains of all queries grow with the block.
                order = np.argsort(docs, kind="stable")
                docs, gain, term = docs[order], gain[order], term[order]
                weight = np.cumsum(np.bincount(docs, count[term], minlength=size))
                step, start = max(1, CELLS // max(1, len(names))), 0
                while start < size:
                    done = weight[start - 1] if start else 0
                    stop = min(size, start + step, max(start + 1, int(np.searchsorted(weight, done + CELLS, "right"))))
                    here = slice(*np.searchsorted(docs, [start, stop]))
                    times = count[term[here]]
                    at = np.repeat(firsts[term[here]] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
                    cell = of_term[at] * (stop - start) + np.repeat(docs[here] - start, times)
                    scores = np.bincount(cell, np.repeat(gain[here], times), minlength=len(names) * (stop - start))
                    yield arrow, ids[start:stop], scores.reshape(len(names), stop - start)
                    start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, arrow, rows = Ranked(len(names), k), None, []
        for arrow, ids, scores in scored(batches):
            best.add(scores, ids)
            if sought.value:
                rows += [(q, i, float(np.round(scores[q, d], SCORE_DIGITS)), True) for d, i in enumerate(ids) for q in sought.value.get(i, ()) if scores[q, d] > 0]
        rows += [(*row, False) for row in _rows(best)]
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(map(list, zip(*rows)), (pa.int32(), arrow, pa.float64(), pa.bool_()))], schema.names)

    named = spark.createDataFrame(list(enumerate(names)), StructType([StructField("_q", IntegerType()), StructField("query_id", queries.select(F.col(query_id)).schema[0].dataType)]))
    hits = blocks.mapInArrow(run, schema)
    if not wanted:
        return top_k(hits.drop("also"), k, by="_q").join(F.broadcast(named), "_q").select("query_id", "id", "rank", "score")
    hits = durable(hits)
    first = top_k(hits.filter("NOT also").drop("also"), k, by="_q")
    later = hits.filter("also").drop("also").join(first.select("_q", "id"), ["_q", "id"], "left_anti")
    places: dict[int, list] = {}
    for q, i, score in later.select("_q", "id", "score").collect():  # at most a row per pair asked for
        places.setdefault(q, []).append((score, i))
    limits = spark.sparkContext.broadcast({q: sorted(some) for q, some in places.items()})

    def count_better(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        better = {q: np.zeros(len(some), np.int64) for q, some in limits.value.items()}
        least = {q: np.array([score for score, _ in some]) for q, some in limits.value.items()}
        arrow = None
        for arrow, ids, scores in scored(batches):
            for q, some in limits.value.items():
                matched = np.flatnonzero(scores[q] > 0)
                found = np.round(scores[q][matched], SCORE_DIGITS)
                low, high = np.searchsorted(least[q], found, "left"), np.searchsorted(least[q], found, "right")
                # A document is better than all places with a lower score, and than those of its score with a larger id.
                better[q] += np.append(np.cumsum(np.bincount(low, minlength=len(some) + 1)[::-1])[::-1], 0)[1:len(some) + 1]
                for n in np.flatnonzero(low < high).tolist():
                    for at in range(low[n], high[n]):
                        better[q][at] += ids[matched[n]] is None or ids[matched[n]] < some[at][1]
        rows = [(q, i, score, int(n)) for q, some in limits.value.items() for (score, i), n in zip(some, better[q])] if arrow is not None else []
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(map(list, zip(*rows)), (pa.int32(), arrow, pa.float64(), pa.int64()))], ["_q", "id", "score", "n"])

    counts = blocks.mapInArrow(count_better, StructType([*schema.fields[:3], StructField("n", LongType())]))
    placed = counts.groupBy("_q", "id", "score").agg((F.sum("n") + 1).cast(first.schema["rank"].dataType).alias("rank"))
    return first.select("_q", "id", "rank", "score").unionByName(placed).join(F.broadcast(named), "_q").select("query_id", "id", "rank", "score")


ROWS_AT_ONCE = 1024  # rows that are counted together


def counted_blocks(rows: DataFrame, names: Sequence[str], averages: Sequence[float], part, docs: int) -> DataFrame:
    """``(field, term, block, df, most, hits)`` of ``rows(id, a token array per field)``, in blocks of ``docs`` rows.

    Rows of a block stand in one task, so its words are counted there and no posting is shuffled.
    """
    hit = StructType([StructField("id", rows.schema["id"].dataType), StructField("tf", LongType()), StructField("doc_len", IntegerType())])
    schema = StructType([StructField("field", StringType()), StructField("term", StringType()), StructField("block", LongType()),
                         StructField("df", LongType()), StructField("most", DoubleType()), StructField("hits", ArrayType(hit))])

    def count(batch: pa.RecordBatch, field: int, first: int) -> pa.RecordBatch:
        column = batch.column(1 + field)
        lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        words, row = pc.list_flatten(column), pc.list_parent_indices(column).to_numpy()
        there = words.is_valid().to_numpy(zero_copy_only=False)
        coded = words.drop_null().dictionary_encode()
        width = max(1, len(coded.dictionary))
        row = row[there].astype(np.int64)
        keys, tf = np.unique(((row // docs) * width + coded.indices.to_numpy()) * docs + row % docs, return_counts=True)
        groups, at = np.unique(keys // docs, return_index=True)
        row = groups.repeat(np.diff(np.append(at, len(keys)))) // width * docs + keys % docs
        most = np.maximum.reduceat(part(tf, lens[row], averages[field]), at) if len(at) else np.empty(0)
        ids = batch.column(0).take(pa.array(row))
        hits = pa.StructArray.from_arrays([ids, pa.array(tf, pa.int64()), pa.array(lens[row], pa.int32())], ["id", "tf", "doc_len"])
        ends = np.append(at, len(keys))
        return pa.record_batch([pa.array([names[field]] * len(at), pa.string()), coded.dictionary.take(pa.array(groups % width)).cast(pa.string()),
                                pa.array(first + groups // width), pa.array(np.diff(ends), pa.int64()), pa.array(most, pa.float64()),
                                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, step = TaskContext.get().partitionId() << 33, max(docs, ROWS_AT_ONCE // docs * docs)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                some = batch.slice(start, step)
                for field in range(len(names)):
                    yield count(some, field, first)
                first += -(-some.num_rows // docs)

    return rows.mapInArrow(run, schema)


class BlockScan:
    """Queries against ``blocks(field, term, block, most, hits)``: only postings of asked terms move, one block's to one task.

    ``weighted`` are ``(query_id, field, term, idf)`` of all queries. A task has a block's postings of all asked terms side
    by side, bounds it for every query and scores it for those it can matter to; what it emits is at most ``k`` rows per query.
    """

    def __init__(self, blocks: DataFrame, weighted: list[tuple], averages: dict[str, float], part, slack: float):
        spark, self.part, self.slack = blocks.sparkSession, part, slack
        self.names = list(dict.fromkeys(r[0] for r in weighted))
        self.number = {q: i for i, q in enumerate(self.names)}
        rarity = {(f, t): idf for _, f, t, idf in weighted}
        keys = sorted(rarity)
        code = {key: i for i, key in enumerate(keys)}
        pairs = sorted((code[f, t], self.number[q]) for q, f, t, _ in weighted)
        count = np.bincount([c for c, _ in pairs], minlength=len(keys))
        self.given = spark.sparkContext.broadcast((
            np.array([rarity[key] for key in keys], float), np.array([averages[f] for f, _ in keys], float),
            np.array([q for _, q in pairs], np.int64), count, np.cumsum(count) - count))
        codes = spark.createDataFrame([(f, t, i) for i, (f, t) in enumerate(keys)], "field string, term string, _code int")
        self.blocks = blocks.join(F.broadcast(codes), ["field", "term"])

    def _side_by_side(self, *columns: str) -> DataFrame:
        return self.blocks.select("block", "_code", *columns).repartition("block").sortWithinPartitions("block")

    def named(self, hits: DataFrame, kind: StructType) -> DataFrame:
        """``query_id`` in place of the number ``_q``."""
        told = hits.sparkSession.createDataFrame(list(enumerate(self.names)), StructType([StructField("_q", IntegerType()), StructField("query_id", kind)]))
        return hits.join(F.broadcast(told), "_q").drop("_q")

    def first(self, n: int) -> DataFrame:
        """``(_q, block)`` of the ``n`` blocks with the highest bounds. Reads no hits."""
        given, queries = self.given, len(self.names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, held, numbers, step = Ranked(queries, n), [], [], max(1, CELLS // max(1, queries))
            for block, codes, rows in _each_block(batches):
                held.append(_bounds(given.value, codes, rows.column(2).to_numpy())[0])
                numbers.append(block)
                if len(held) == step:
                    best.add(np.stack(held, axis=1), numbers)
                    held, numbers = [], []
            if held:
                best.add(np.stack(held, axis=1), numbers)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(map(list, zip(*_rows(best)) if _rows(best) else ([], [], [])), (pa.int32(), pa.int64(), pa.float64()))], ["_q", "block", "bound"])

        bounds = self._side_by_side("most").mapInArrow(run, "_q int, block bigint, bound double")
        return top_k(bounds, n, by="_q", score="bound", id_col="block").select("_q", "block")

    def _limits(self, floors: dict, done: list[tuple]):
        """Scores to reach, by query, and the queries that have seen a block, by block."""
        floor = np.zeros(len(self.names))
        for q, least in floors.items():
            floor[self.number[q]] = least
        seen: dict[int, list] = {}
        for q, block in done:
            seen.setdefault(block, []).append(self.number[q])
        return self.blocks.sparkSession.sparkContext.broadcast((floor, seen))

    def open_pairs(self, floors: dict, done: list[tuple]) -> DataFrame:
        """``(_q, block)`` that are not done and whose bound reaches the query's floor."""
        given, limits, slack = self.given, self._limits(floors, done), self.slack

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            floor, seen = limits.value
            for block, codes, rows in _each_block(batches):
                asking = _asking(_bounds(given.value, codes, rows.column(2).to_numpy())[0], floor - slack, seen.get(block))
                yield pa.record_batch([pa.array(asking, pa.int32()), pa.array(np.full(len(asking), block, np.int64))], ["_q", "block"])

        return self._side_by_side("most").mapInArrow(run, "_q int, block bigint")

    def rest(self, k: int, floors: dict, done: list[tuple], id_type) -> DataFrame:
        """``(_q, id, score)``: the best ``k`` of each task among the blocks that are not done."""
        given, limits, slack, part, queries = self.given, self._limits(floors, done), self.slack, self.part, len(self.names)
        schema = StructType([StructField("_q", IntegerType()), StructField("id", id_type), StructField("score", DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (floor, seen), best, kind = limits.value, Ranked(queries, k), None
            rarity, average = given.value[:2]
            best.floor = floor.copy()
            for block, codes, rows in _each_block(batches):
                bounds, query, place = _bounds(given.value, codes, rows.column(2).to_numpy())
                asking = _asking(bounds, best.floor - slack, seen.get(block))
                if not len(asking):
                    continue
                hits = rows.column(3)
                term, hits = pc.list_parent_indices(hits).to_numpy(), pc.list_flatten(hits)
                ids, tf, length = (hits.field(i) for i in range(3))
                kind, ids = ids.type, ids.dictionary_encode("encode")
                doc, size = ids.indices.to_numpy(), len(ids.dictionary)
                gain = rarity[codes[term]] * part(tf.to_numpy(), length.to_numpy(), average[codes[term]])
                gains = np.bincount(term.astype(np.int64) * size + doc, gain, minlength=len(codes) * size).reshape(len(codes), size)
                at = np.full(queries, -1)
                at[asking] = np.arange(len(asking))
                names, step = ids.dictionary.to_pylist(), max(1, CELLS // max(len(codes), size))
                for start in range(0, len(asking), step):
                    some = asking[start:start + step]
                    mine = (at[query] >= start) & (at[query] < start + len(some))
                    asked = np.zeros((len(some), len(codes)))
                    asked[at[query[mine]] - start, place[mine]] = 1
                    best.add(asked @ gains, names, some)
            rows = _rows(best)
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(map(list, zip(*rows)), (pa.int32(), kind, pa.float64()))], schema.names)

        return self._side_by_side("most", "hits").mapInArrow(run, schema)


def _rows(best: Ranked) -> list[tuple]:
    return [(q, i, -s) for q, hits in enumerate(best.hits) for s, _, i in hits]


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """``(block, codes, rows)`` of rows that come in order of their block; a block may go over several batches."""
    held: pa.RecordBatch | None = None
    for batch in chain(batches, [None]):
        if batch is not None and not batch.num_rows:
            continue
        rows = held if batch is None else batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if rows is None:
            return
        block, codes = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        held = rows.slice(cuts[-2])  # may go on in the next batch
        for start, stop in zip(cuts, cuts[1:] if batch is None else cuts[1:-1]):
            yield int(block[start]), codes[start:stop], rows.slice(start, stop - start)


def _bounds(given: tuple, codes: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What no document of a block exceeds, by query; and the pairs of query and place in ``codes`` behind it."""
    rarity, _, of_query, count, firsts = given
    times = count[codes]
    query = of_query[np.repeat(firsts[codes] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
    bounds = np.bincount(query, np.repeat(rarity[codes] * most, times))
    return np.pad(bounds, (0, int(of_query.max()) + 1 - len(bounds))), query, np.repeat(np.arange(len(codes)), times)


def _asking(bounds: np.ndarray, least: np.ndarray, seen: list[int] | None) -> np.ndarray:
    there = (bounds > 0) & (bounds >= least)
    if seen:
        there[seen] = False
    return np.flatnonzero(there)

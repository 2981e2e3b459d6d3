"""Passages that repeat: sparse suffix arrays over words.

Of every ``WINDOW`` neighbouring runs of ``GRAM`` words the one with the smallest hash is a
minimiser; it depends on the content alone, so a passage of ``LEAST`` words has the same minimisers
wherever it stands. Only suffixes that begin at minimisers are retained, and of these only those whose
first words occur twice at least. They are sorted by the words that follow, and by the words that
go before; neighbours in either order are compared and the match extended right and left. Matches of
``LEAST`` words or more mark their words; marked words that touch form one passage.

Neighbours have the longest match to the right (or left), not always the longest in both
directions together. Where an entry's longest match to the right and to the left would together reach further
than its matches with its neighbours do, all entries with these first words take the exact way: they are grouped
by the hashes of their windows of ``LEAST`` words.

A suffix carries the words around it that a window can hold, no text. The sorts are range sorts, so that words
that stand in a third of all texts are spread; neighbours across partitions meet through the first and
last entries of each partition. Equal texts count once and share the result; a text that has an equal one is
one passage if long enough.

Null, empty and short texts have no passages. Passages that repeat within one text count. Rows
with a null id are left out; repeated rows of one id with one text count as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mnemospark.llm import shingles
from mnemospark.llm.staging import stage

LEAST = 50  # words of the shortest passage
GRAM = 10
WINDOW = LEAST - GRAM + 1  # runs of which one is a minimiser: every passage holds one
BEFORE = LEAST - GRAM  # words before a suffix's first words that a window can hold
PIECE = 128


def minimisers(grams: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest (leftmost among equals) of each ``window`` neighbours within a text.

    ``grams`` are those of several texts side by side, ``counts`` their numbers, ``window`` at least. The smallest of spans
    of doubling length are compared, so a place costs a few steps whatever the window.
    """
    if not len(grams):
        return np.empty(0, np.int64)
    least, place, span = grams, np.arange(len(grams), dtype=np.int32), 1
    while span < window:
        step = min(span, window - span)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.minimum(least[step:], least[:-step])
        span += step
    ends = np.cumsum(counts)
    inside = np.ones(len(grams), bool)
    for back in range(1, window):
        inside[ends - back] = False  # windows that reach into the next text
    place = place[inside[:len(place)]]
    return place[np.flatnonzero(np.diff(place, prepend=-1))].astype(np.int64)  # places never go back


def _grams(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``GRAM`` words, as ``shingles.runs`` gives them, of texts with so many words at least."""
    n = len(words) - GRAM + 1
    value = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(GRAM):
            value = shingles.mix(value * shingles.ODD + words[j:j + n] + np.uint64(j + 1))
    inside = np.ones(len(words), bool)
    ends = np.cumsum(counts)
    for back in range(1, GRAM):
        inside[ends - back] = False
    return value[inside[:n]]


def _cut(words: np.ndarray, counts: np.ndarray, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in a text the 4-byte words that follow, and those before in reverse, big-endian; 0 stands beyond the text."""
    small = ((words >> np.uint64(32)).astype(np.uint32) | np.uint32(1)).astype(">u4").view(np.uint32)
    firsts = np.cumsum(counts) - counts
    wide = np.zeros(len(words) + (BEFORE + LEAST) * len(counts), np.uint32)
    gap = np.arange(len(counts)) * (BEFORE + LEAST) + BEFORE
    wide[np.arange(len(words)) + np.repeat(gap, counts)] = small
    lines = np.lib.stride_tricks.sliding_window_view(wide, BEFORE + LEAST)[(firsts + gap)[text] + at - BEFORE]
    return lines[:, BEFORE:], lines[:, BEFORE - 1::-1]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of big-endian 4-byte words as binary, so that bytes sort as the words do."""
    width = rows.shape[1] * 4
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)), pa.py_buffer(data)])


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """The 4-byte words of ``_binary`` as they lie in memory: good for comparing, not for counting."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.uint32).reshape(len(column), width)


def _entries(batches: Iterator[pa.RecordBatch], keys_only: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), PIECE):
            part = batch.slice(start, PIECE)
            words, counts = shingles.words([t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()])
            long = counts >= LEAST
            if not long.any():
                continue
            words, counts, ids = words[np.repeat(long, counts)], counts[long], part.column("id").to_numpy()[long]
            grams, sizes = _grams(words, counts), counts - GRAM + 1
            place = minimisers(grams, sizes)
            key = pa.array(grams[place].view(np.int64))
            if keys_only:
                yield pa.RecordBatch.from_arrays([key], ["key"])
                continue
            ends = np.cumsum(sizes)
            text = np.searchsorted(ends, place, "right")
            at = place - (ends - sizes)[text]
            right, left = _cut(words, counts, text, at)
            yield pa.RecordBatch.from_arrays([pa.array(ids[text], pa.int64()), pa.array(at, pa.int32()), key, _binary(right), _binary(left)], ["id", "at", "key", "right", "left"])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading words that two rows share, up to the end of a text."""
    same = (a == b) & (a != 0)
    return np.where(same.all(1), a.shape[1], same.argmin(1))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sorted entry with its matches to the entry before and the one after: words left and right.

    The first and last entry of the partition come out once more as they are, for the borders.
    """
    held = None  # last entry of the batch before
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        right, left, key = _rows(batch.column("right"), LEAST), _rows(batch.column("left"), BEFORE), batch.column("key").to_numpy()
        same = key[1:] == key[:-1]
        r = np.where(same, _common(right[1:], right[:-1]), 0)
        l = np.where(same, _common(left[1:], left[:-1]), 0)
        ids, at = batch.column("id").to_numpy(), batch.column("at").to_numpy()
        for side in (slice(1, None), slice(None, -1)):
            keep = same
            yield pa.RecordBatch.from_arrays([pa.array(ids[side][keep]), pa.array(at[side][keep]), pa.array(key[side][keep]),
                                              pa.array(l[keep], pa.int32()), pa.array(r[keep], pa.int32()), pa.nulls(int(keep.sum()), pa.binary()), pa.nulls(int(keep.sum()), pa.binary())],
                                             ["id", "at", "key", "l", "r", "right", "left"])
        border = ([batch.slice(0, 1)] if held is None else [])
        held = batch.slice(len(batch) - 1, 1)
        for b in border:
            yield _as_border(b)
    if held is not None:
        yield _as_border(held)


def _as_border(entry: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.array([-1], pa.int32())
    return pa.RecordBatch.from_arrays([entry.column("id"), entry.column("at"), entry.column("key"), none, none, entry.column("right"), entry.column("left")], ["id", "at", "key", "l", "r", "right", "left"])


MATCH = "id long, at int, key long, l int, r int, right binary, left binary"


def _matches(entries: DataFrame, order: str) -> DataFrame:
    """Matches ``(id, at, key, l, r)`` of neighbours in the order of ``right`` or ``left``."""
    other = "left" if order == "right" else "right"
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = entries.select("id", "at", "key", "right", "left").repartitionByRange(n, "key", order, other, "id", "at").sortWithinPartitions("key", order, other, "id", "at")
    found = stage(ordered.mapInArrow(_neighbours, MATCH), "repeats-" + order)
    # Two entries per partition meet their neighbours across the borders in one small task.
    borders = found.where("l = -1").select("id", "at", "key", "right", "left").distinct().repartitionByRange(1, "key").sortWithinPartitions("key", order, other, "id", "at")
    across = borders.mapInArrow(_neighbours, MATCH)
    return found.unionByName(across).where("l >= 0").select("id", "at", "key", "l", "r")


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of ``LEAST`` words around an entry that lies within its text.

    Sums of mixed words by powers of an odd number are carried along, so that a window is the difference of two.
    """
    with np.errstate(over="ignore"):
        drop = np.uint64(pow(int(shingles.ODD), LEAST, 1 << 64))
    for batch in batches:
        for start in range(0, len(batch), 512):
            part = batch.slice(start, 512)
            n = len(part)
            line = np.concatenate([_rows(part.column("left"), BEFORE)[:, ::-1], _rows(part.column("right"), LEAST)], axis=1).T.astype(np.uint64)
            sums, gone = np.zeros((len(line) + 1, n), np.uint64), np.zeros((len(line) + 1, n), np.int32)
            np.cumsum(line == 0, axis=0, out=gone[1:])
            with np.errstate(over="ignore"):
                mixed = shingles.mix(line + shingles.ODD)
                for j in range(len(line)):
                    sums[j + 1] = sums[j] * shingles.ODD + mixed[j]
                h = shingles.mix(sums[LEAST:] - sums[:-LEAST] * drop)[::-1]  # by the number of words before the entry
            before, entry = np.nonzero((gone[LEAST:] == gone[:-LEAST])[::-1])
            ids, at, key = (part.column(c).to_numpy()[entry] for c in ("id", "at", "key"))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(at), pa.array(key), pa.array(before, pa.int32()), pa.array(h[before, entry].view(np.int64))], ["id", "at", "key", "l", "h"])


def repeated_passages(docs: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, first_word, last_word, n_words)``: passages of ``LEAST`` words or more that stand twice at least.

    Words are counted from 0; ``last_word`` is the last one's number.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    hashed = rows.select("id", F.sha2("text", 256).alias("h"))
    alike = hashed.groupBy("h").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("n")).where("n > 1")
    copies = stage(hashed.join(alike, "h").select("id", "rep").distinct(), "repeats-copies")
    single = rows.join(copies.where("id <> rep").select("id"), "id", "left_anti")
    keys = single.mapInArrow(lambda b: _entries(b, True), "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = stage(keys.select("key"), "repeats-keys")
    entries = stage(single.mapInArrow(lambda b: _entries(b, False), "id long, at int, key long, right binary, left binary").join(keys, "key", "left_semi"), "repeats-entries")
    found = stage(_matches(entries, "right").unionByName(_matches(entries, "left")), "repeats-found")
    spans = found.where(F.col("l") + F.col("r") >= LEAST).select("id", (F.col("at") - F.col("l")).alias("a"), (F.col("at") + F.col("r")).alias("b"))
    # Entries whose best sides together promise more than one neighbour gives.
    best = found.groupBy("id", "at", "key").agg(F.max("l").alias("l"), F.max("r").alias("r"), F.max(F.when(F.col("l") + F.col("r") >= LEAST, F.struct((F.col("l") + F.col("r")).alias("n"), "l", "r"))).alias("m"))
    tangled = best.where((F.col("l") + F.col("r") >= LEAST) & (F.col("m").isNull() | (F.col("m.l") < F.col("l")) | (F.col("m.r") < F.col("r")))).select("key").distinct()
    windows = entries.join(tangled, "key", "left_semi").mapInArrow(_window_hashes, "id long, at int, key long, l int, h long")
    twice = windows.groupBy("key", "l", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    more = windows.join(twice, ["key", "l", "h"], "left_semi").select("id", (F.col("at") - F.col("l")).alias("a"), (F.col("at") - F.col("l") + LEAST).alias("b"))
    # A text with an equal one is one passage.
    whole = rows.join(copies, "id").select("id", F.size(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)).alias("b")).where(F.col("b") >= LEAST).select("id", F.lit(0).alias("a"), "b")
    return _merged(spans.unionByName(more).unionByName(whole)).select(F.col("id").alias(key), F.col("a").alias("first_word"), (F.col("b") - 1).alias("last_word"), (F.col("b") - F.col("a")).alias("n_words"))


def _merged(spans: DataFrame) -> DataFrame:
    """Spans of each text that overlap or touch, as one."""
    from pyspark.sql import Window
    w = Window.partitionBy("id").orderBy("a", "b")
    before = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.distinct().withColumn("new", F.coalesce((F.col("a") > before).cast("int"), F.lit(1)))
    grouped = marked.withColumn("g", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("id", "g").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("g")

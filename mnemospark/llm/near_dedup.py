"""Near-duplicates by BagMinHash over multisets of word shingles.

A text's bag holds its runs of ``SHINGLE`` words with their counts; two texts are near if
sum(min) / sum(max) of the counts is at least ``SIMILARITY``.

Signature: every shingle owns Poisson processes on its weight axis, one for each block [0,1), [1,2),
[2,4), [4,8) ... of levels. A point has a time, a level within its block and one of the signature's
places; a shingle of count w sees the points of levels below w. A place keeps the earliest point's
hash. Equal places are then an unbiased estimate of the weighted similarity. Points are drawn in order of
time only up to a horizon after which no place can change; it is doubled while a place is empty.

Steps: equal texts fall together by hash, one stays for them. Signatures are cut into ``BANDS`` bands;
texts that share a band form a bucket, whose head is compared exactly with every other member. By the
triangle inequality these similarities tell which members may have links that the head does not show.
Those, whatever their number, are described by how they differ from the head: two near texts, one of which misses the
head, share a part of these differences, so one of the rarest of each; enough are taken that none can be lost. Copies of
one text that are too far from it and from each other differ in places of their own and do not meet. Pairs within a
bucket are never spelled out. Links become classes.

Null, empty and blank texts have no shingles and stay alone; texts of fewer words than a shingle are
near only to equal word sequences. Rows with a null id are left out. Repeated ids count once; an id with
several texts is near to whatever one of them is near to, and all of them are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mnemospark.llm import shingles
from mnemospark.llm.components import components
from mnemospark.llm.staging import stage
from mnemospark.session import sized

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4  # a pair at 0.8 shares no band with a chance of 5e-8
PLACES = BANDS * ROWS
HAS_WORDS = r"[^\x20\x09-\x0D]"
BORDER = 0.5  # similarity to a head from which on a text is described by its differences from it
PIECE = 128  # texts worked on together


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def bags(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, distinct shingle and its count, from all shingles of some texts in a row."""
    owner = np.repeat(np.arange(len(counts)), counts)
    with np.errstate(over="ignore"):
        key = shingles.mix(values + owner.astype(np.uint64) * shingles.ODD)  # one hash for both sorts faster
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return owner[order[at]], values[order[at]], np.diff(np.append(at, len(values)))


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """BagMinHash signatures (n, places) as 64-bit hashes; texts without shingles get zeros."""
    total = np.bincount(owner, weight, minlength=n)
    horizon = np.full(n, np.inf)
    horizon[total > 0] = (np.log(places) + 3) / total[total > 0]  # leaves a place empty in one text of twenty
    best = np.full((n, places), np.inf)
    value = np.zeros((n, places), np.uint64)
    todo = total > 0
    while todo.any():
        live = todo[owner]
        low = 0  # blocks of levels: [0,1), then [2^(b-1), 2^b)
        block = 0
        own, key, w = owner[live], shingle[live], weight[live]
        while len(own):
            size = 1 if block == 0 else 1 << (block - 1)
            ids, time, seen, many = np.arange(len(own)), np.zeros(len(own)), 0, 1
            while len(ids):
                # One point each at first, then twice as many at once: few shingles own many points before the horizon.
                with np.errstate(over="ignore"):
                    turns = np.arange(seen + 1, seen + 1 + many, dtype=np.uint64) + np.uint64(block * 1_000_003)
                    h = shingles.mix(key[ids][:, None] + turns * shingles.ODD)
                    level_h, place_h = shingles.mix(h + np.uint64(1)), shingles.mix(h + np.uint64(2))
                at = time[:, None] - np.cumsum(np.log(_unit(h)), axis=1) / (places * size)
                level = low + np.floor(_unit(level_h) * size)
                near = at <= horizon[own[ids]][:, None]
                row, col = np.nonzero(near & (level < w[ids][:, None]))  # the level's unit step belongs to the weight
                who, where, when, what = own[ids][row], (place_h[row, col] % np.uint64(places)).astype(np.int64), at[row, col], h[row, col]
                seen += many
                more = near[:, -1]
                ids, time, many = ids[more], at[more, -1], min(2 * many, 1024)
                order = np.argsort(-when, kind="stable")  # the earliest is written last
                who, where, when, what = who[order], where[order], when[order], what[order]
                better = when < best[who, where]
                value[who[better], where[better]] = what[better]
                best[who[better], where[better]] = when[better]
            low += size
            block += 1
            more = w > low
            own, key, w = own[more], key[more], w[more]
        todo &= np.isinf(best).any(1)
        horizon[todo] *= 2
    return value


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    for start in range(0, len(column), PIECE):
        yield [t or b"" for t in column.slice(start, PIECE).cast(pa.binary()).to_pylist()]


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in _texts(batch.column("text")):
            values, counts = shingles.runs(*shingles.words(texts), SHINGLE)
            sig = signatures(*bags(values, counts), len(texts)).reshape(len(texts), BANDS, ROWS)
            band = np.zeros((len(texts), BANDS), np.uint64)
            with np.errstate(over="ignore"):
                for r in range(ROWS):
                    band = shingles.mix(band * shingles.ODD + sig[:, :, r] + np.uint64(r))
                band = shingles.mix(band + np.arange(BANDS, dtype=np.uint64))
            full = counts > 0
            flat = pa.array(band[full].reshape(-1).view(np.int64))
            offsets = pa.array(np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(texts)), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, flat)], ["id", "size", "bands"])
            at += len(texts)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted elements of each text's bag: the j-th occurrence of a shingle is an element of its own."""
    for batch in batches:
        at = 0
        for texts in _texts(batch.column("text")):
            values, counts = shingles.runs(*shingles.words(texts), SHINGLE)
            owner, shingle, weight = bags(values, counts)
            nth = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
            with np.errstate(over="ignore"):
                element = np.where(nth == 0, np.repeat(shingle, weight), shingles.mix(np.repeat(shingle, weight) + nth.astype(np.uint64) * shingles.ODD))
            who = np.repeat(owner, weight)
            element = element.view(np.int64)[np.lexsort((element.view(np.int64), who))]
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(texts)), pa.ListArray.from_arrays(offsets, pa.array(element))], ["id", "bag"])
            at += len(texts)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Common elements of each row's two bags; the bags themselves go."""
    for batch in batches:
        left, right = batch.column("bag_a"), batch.column("bag_b")
        common = [len(np.intersect1d(left[i].values.to_numpy(), right[i].values.to_numpy(), assume_unique=True)) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64())], ["a", "b", "common"])


def _side_by_side(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """The two bags of each pair (a, b); bags that no pair asks for stay where they are."""
    asked = sized(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    kept = kept.join(asked, "id", "left_semi")
    left, right = (kept.select(F.col("id").alias(s), F.col("bag").alias("bag_" + s)) for s in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b")


def _verified(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Pairs (a, b, size_a, size_b) with their exact similarity."""
    # Bags travel as compact arrays; a batch is kept small, since bags may be long.
    common = _side_by_side(pairs, kept).mapInArrow(_compare, "a long, b long, common long")
    sized = common.join(pairs.select("a", "b", "size_a", "size_b"), ["a", "b"])
    return sized.select("a", "b", (F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))).alias("similarity"))


def near_classes(docs: DataFrame, text_col: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """``(key, class, size)`` for each id: the class is its smallest id, ``size`` the number of its members."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    rows, more = _told_apart(rows)
    hashed = rows.select("id", F.when(F.col("text").rlike(HAS_WORDS), F.sha2("text", 256)).alias("h"))
    alike = hashed.where("h is not null").groupBy("h").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    copies = stage(hashed.where("h is not null").join(alike.where("n > 1"), "h").select("id", "rep").where("id <> rep").distinct(), "near-copies")
    firsts = rows.where("text is not null").join(copies.select("id").distinct(), "id", "left_anti")
    banded = stage(firsts.mapInArrow(_bands, "id long, size long, bands array<long>").where("size > 0"), "near-bands")
    long = banded.select("id", "size", F.explode("bands").alias("band"))
    # Of each bucket of two or more, the text whose bands most others share is its head: near copies lie around it.
    crowded = long.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = stage(long.join(crowded, "band"), "near-shared")
    popular = shared.groupBy("id").agg(F.sum("members").alias("pop"))
    heads = shared.join(popular, "id").groupBy("band").agg(F.max(F.struct("pop", (-F.col("id")).alias("least"), "id", "size")).alias("head"))
    members = stage(shared.join(heads.select("band", F.col("head.id").alias("a"), F.col("head.size").alias("size_a")), "band")
                    .where("id <> a").select("band", "a", F.col("id").alias("b"), "size_a", F.col("size").alias("size_b")), "near-members")
    ratio = F.least("size_a", "size_b") / F.greatest("size_a", "size_b")  # no similarity is larger
    pairs = members.groupBy("a", "b").agg(F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b"))
    possible = stage(pairs.where(ratio >= similarity), "near-pairs")
    wanted = members.select(F.col("a").alias("id")).union(members.select(F.col("b").alias("id"))).distinct()
    kept = stage(firsts.join(sized(wanted), "id").mapInArrow(_bags, "id long, bag array<long>"), "near-bags")
    compared = stage(_verified(possible, kept), "near-compared")
    checked = compared.where(F.col("similarity") >= similarity)
    links = checked.select("a", "b")
    rest = stage(_unsettled(members.join(compared, ["a", "b"], "left").select("band", "a", "b", "size_a", "size_b", F.coalesce("similarity", ratio).alias("s")), similarity), "near-rest")
    if not rest.isEmpty():
        links = links.union(_rest_links(rest, kept, checked, similarity))
    classes = components(links)
    # Copies follow their first.
    near = rows.select("id").distinct().join(copies, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
    named = near.join(classes.select(F.col("id").alias("rep"), "class"), "rep", "left").select("id", F.coalesce("class", "rep").alias("class"))
    if more is not None:  # the texts of an id belong together; only ids have names
        named = stage(named, "near-named")
        whole = components(named.select(F.col("id").alias("a"), F.col("class").alias("b")).union(more.select("id", "own")))
        named = named.join(more.select("id"), "id", "left_anti").join(whole.select("id", F.col("class").alias("all")), "id", "left").select("id", F.coalesce("all", "class").alias("all"))
        named = named.join(named.groupBy("all").agg(F.min("id").alias("class")), "all").select("id", "class")
    sizes = named.groupBy("class").agg(F.count(F.lit(1)).alias("size"))
    return named.join(sizes, "class").select(F.col("id").alias(key), "class", "size")


def _told_apart(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows(id, text)`` with one text for each id, and what was given another name for that: ``(id, own)``.

    The first text of a repeated id, by hash, keeps the id; others get a hash of id and text for one. Repeated texts of
    an id stay once, blank ones only beside no other.
    """
    x = F.when(F.col("text").rlike(HAS_WORDS), F.xxhash64("text"))
    repeated = stage(rows.select("id", x.alias("x")).groupBy("id").agg(F.min("x").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "least"), "near-repeated")
    if repeated.isEmpty():
        return rows, None
    again = rows.join(repeated, "id").withColumn("x", x).where("x is not null or least is null")
    again = again.select(F.col("id").alias("own"), F.when(F.col("x") != F.col("least"), F.xxhash64("id", "x")).otherwise(F.col("id")).alias("id"), "text").groupBy("id").agg(F.min("own").alias("own"), F.first("text").alias("text"))
    more = stage(again.where("id <> own").select("id", "own"), "near-more")
    return rows.join(repeated, "id", "left_anti").unionByName(again.select("id", "text")), None if more.isEmpty() else more


def _unsettled(members: DataFrame, similarity: float) -> DataFrame:
    """``(a, b, size_a, size_b, missed)``: heads and members that may have a link which the head does not show.

    ``members(band, a, b, size_a, size_b, s)`` holds the similarity ``s`` to the head. 1 - s is a metric: a text that
    misses the head can be near a text that matches it only if their distances from the head differ by the
    threshold's distance at most. Texts that miss the same head may be near each other.
    """
    slack = 1 - similarity
    missed = F.col("s") < similarity
    per = members.groupBy("band").agg(F.count(F.when(missed, 1)).alias("n"), F.max(F.when(missed, F.col("s"))).alias("best"),
                                      F.min(F.when(~missed, F.col("s"))).alias("worst"))
    close = per.withColumn("reach", F.col("best") >= F.coalesce(F.col("worst"), F.lit(2.0)) - slack - 1e-9).where("n > 1 or (n = 1 and reach)")
    needed = missed | (F.col("reach") & (F.col("s") <= F.col("best") + slack + 1e-9))
    return members.join(close, "band").where(needed).select("a", "b", "size_a", "size_b", missed.alias("missed")).distinct()


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements that only one of each row's two bags holds; the bags themselves go."""
    for batch in batches:
        left, right = batch.column("bag_a"), batch.column("bag_b")
        other = [np.setxor1d(left[i].values.to_numpy(), right[i].values.to_numpy(), assume_unique=True) for i in range(len(batch))]
        flat = pa.array(np.concatenate([np.empty(0, np.int64), *other]), pa.int64())
        offsets = pa.array(np.cumsum([0, *map(len, other)]), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.ListArray.from_arrays(offsets, flat)], ["a", "b", "other"])


def _rest_links(rest: DataFrame, kept: DataFrame, checked: DataFrame, similarity: float) -> DataFrame:
    """Links among members of one bucket of which one misses the head.

    Near texts are about as far from the head: their similarities to it differ by 1 - ``similarity`` at most. So with any
    border, either both lie above it, or both below the border and that much more. Above, texts share most of the head
    and are told apart by their differences from it; below, by their own shingles.
    """
    apart = _side_by_side(rest.select("a", "b"), kept).mapInArrow(_differences, "a long, b long, other array<long>")
    apart = stage(apart.join(rest, ["a", "b"]).withColumn("d", F.size("other")), "near-differences")
    whole = F.col("size_a") + F.col("size_b")
    s = (whole - F.col("d")) / (whole + F.col("d"))
    known = components(checked.select("a", "b"))  # texts of one class need no more links
    far = stage(apart.where(s < BORDER + 1 - similarity + 1e-9).select(F.col("b").alias("id"), F.col("size_b").alias("size")).distinct(), "near-far")
    pairs = _difference_pairs(apart.where(s >= BORDER - 1e-9), known, similarity)
    if not far.isEmpty():
        pairs = pairs.union(_prefix_pairs(far, kept, known, similarity))
    return _verified(stage(pairs.distinct(), "near-pairs"), kept).where(F.col("similarity") >= similarity).select("a", "b")


def _difference_pairs(apart: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Pairs that may be near, by an exact prefix join over the differences of members from their head.

    Let D be the elements that only one of a text and its head holds, c = (1 - similarity) / (1 + similarity), and the
    bags' sizes x, y and h of the head. Bags are near if they differ in c * (x + y) elements at most, so near bags
    have o >= (|D1| + |D2| - c * (x + y)) / 2 elements of D1 and D2 in common. The first misses the head: |D1| > c * (x + h).
    For the second, whatever it is, o > (|D2| + c * (h - y)) / 2, and the same for the first if the second
    misses the head too. Else, as o <= |D2| and y <= x / similarity, o >= |D1| - c * x * (1 + 1 / similarity).
    Two sets with o common elements share one of the first |D| - o + 1 of each, in any one order; here the rarest
    of a head come first. Elements that no other member has only count.
    """
    items = apart.select("a", "b", F.explode("other").alias("e"))
    often = items.groupBy("a", "e").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = items.join(often, ["a", "e"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("es"))
    c = (1 - similarity) / (1 + similarity)
    lone = F.col("d") - F.size("es")
    length = lambda least: F.greatest(F.lit(0), F.col("d") - F.greatest(F.lit(1), F.ceil(least - 1e-9)) + 1 - lone).cast("int")
    short = length((F.col("d") + c * (F.col("size_a") - F.col("size_b"))) / 2)
    long = F.when(F.col("missed"), F.greatest(short, length(F.col("d") - c * F.col("size_b") * (1 + 1 / similarity)))).otherwise(short)
    both = shared.join(apart.drop("other"), ["a", "b"]).withColumn("short", short).select("a", "b", "size_b", "missed", "short", "d", F.size("es").alias("many"), F.posexplode(F.slice("es", F.lit(1), long)).alias("pos", "x"))
    prefix = both.select("a", F.col("b").alias("id"), F.col("size_b").alias("size"), "missed", "d", (F.col("many") - F.col("pos")).alias("left"), F.col("x.e").alias("e"), (F.col("pos") < F.col("short")).alias("short"))
    prefix = stage(prefix.join(known, "id", "left").select("a", "id", "size", "missed", "d", "left", "e", "short", F.coalesce("class", "id").alias("class")), "near-prefix")
    one, two = (prefix.select("a", "e", *[F.col(x).alias(f"{x}_{s}") for x in ("id", "size", "missed", "d", "left", "short", "class")]) for s in "xy")
    # From the first element that they share, no more can be shared than both have left.
    enough = 2 * F.least("left_x", "left_y") >= F.col("d_x") + F.col("d_y") - c * (F.col("size_x") + F.col("size_y")) - 1e-9
    pairs = one.where("missed_x").join(two.where("short_y"), ["a", "e"]).where(
        F.when(F.col("missed_y"), F.col("short_x") & (F.col("id_x") < F.col("id_y"))).otherwise(F.lit(True)) & (F.col("class_x") != F.col("class_y"))
        & enough & (F.least("size_x", "size_y") >= similarity * F.greatest("size_x", "size_y")))
    return pairs.select(F.col("id_x").alias("a"), F.col("id_y").alias("b"), F.col("size_x").alias("size_a"), F.col("size_y").alias("size_b"))


def _prefix_pairs(rest: DataFrame, kept: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Pairs among ``rest`` that may be near, by an exact prefix join: elements ordered by how many of these texts hold them.

    Near bags of sizes x >= y have at least similarity / (1 + similarity) * (x + y) common elements. So they share
    an element among the first x - ceil(similarity * x) + 1 of the larger and the first
    y - ceil(2 * similarity / (1 + similarity) * y) + 1 of the smaller. Elements that no other text holds come
    first and only count: most texts of a common passage have nothing else in these places.
    """
    items = kept.join(rest, "id").select("id", "size", F.explode("bag").alias("e"))
    often = items.groupBy("e").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = items.join(often, "e").groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("es")).withColumn("common", F.size("es"))
    length = lambda part: F.greatest(F.lit(0), F.col("common") - F.ceil(F.col("size") * part - 1e-9) + 1).cast("int")  # noqa: E731  of the prefix, less the lone elements
    both = shared.withColumn("short", length(2 * similarity / (1 + similarity))).select("id", "size", "common", "short", F.posexplode(F.slice("es", F.lit(1), length(similarity))).alias("pos", "x"))
    prefix = both.select("id", "size", "common", F.col("x.e").alias("e"), (F.col("pos") < F.col("short")).alias("short"))
    prefix = stage(prefix.join(known, "id", "left").select("id", "size", "common", "e", "short", F.coalesce("class", "id").alias("class")), "near-prefix")
    a, b = (prefix.select("e", "short", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "size", "common", "class")]) for s in "ab")
    larger = F.struct("size_a", "id_a") > F.struct("size_b", "id_b")
    enough = F.least("common_a", "common_b") >= similarity / (1 + similarity) * (F.col("size_a") + F.col("size_b")) - 1e-9
    pairs = a.drop("short").join(b.where("short").drop("short"), "e").where(
        larger & enough & (F.col("class_a") != F.col("class_b")) & (F.col("size_b") >= similarity * F.col("size_a")))
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "size_a", "size_b")

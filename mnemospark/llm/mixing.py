"""Mixing sources to target weights: exact quotas, a splitting tree over the output shards, disjoint draws.

A text's size is its number of words. Sources, in code point order with null last, weigh 3, 1, 2,
repeating, and share ``SHARE`` times all words; none gets more than twice its own words, what it
cannot take is shared again by weight.

A target is made of whole passes over the source and a last pass that stops at the target. Each
source is cut into ``BLOCKS`` blocks by a hash of its rows, and every pass draws its blocks in an order of
its own. The numbers of drawn blocks are dealt to the output shards by a binary tree: at each
node the left half receives a multivariate hypergeometric draw of the node's blocks, so that every shard
holds what a random permutation of all blocks would give it, with exact sums. A shard takes
consecutive blocks of each source's order, so draws are disjoint; rows are ordered by a hash within
their shard.

Only DataFrame expressions. Per source there is a row of ``BLOCKS`` sums; the texts are read once.
Null and empty texts have size 0: they are never needed for a target and are taken as often as their pass
draws them. A null source is a source. Repeated rows are rows of their own, told apart by their
number among equal rows only in the last pass of one block. All draws come from hashes of rows and
``seed``: reruns agree. Input columns keep their values; added ones replace equal names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mnemospark.llm.staging import stage, unit, word_count

WEIGHTS = (3, 1, 2)  # fixed values, repeating
SHARE = 1.5
MOST = 2  # most times that a source is taken
BLOCKS = 1024  # blocks of a source; a block is small against the source at any size
SHARDS = 16  # output shards, a power of two
SEED = 20


def targets(totals: DataFrame, size: str = "source_size") -> DataFrame:
    """``target`` (double) for each row of (source, size): shared by weight up to ``MOST`` times the size.

    The share per weight rises until all is given: sources whose limit per weight is lowest fill up first.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("double")
    limit = F.lit(float(MOST)) * F.col(size)
    df = totals.withColumn("weight", weight).withColumn("limit", limit)
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(SHARE) * F.sum(size).over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    df = df.withColumn("level", level)
    # The first source that the level does not fill sets the level of all after it.
    first = F.min(F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct((F.col("limit") / F.col("weight")).alias("at"), "level"))).over(every)
    return df.withColumn("target", F.coalesce(F.least(F.col("limit"), first["level"] * F.col("weight")), F.col("limit"))).drop("limit", "level")


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked items among ``drawn`` of ``total``, by walking the distribution from its mode until ``u`` is used up."""
    low, high = F.greatest(F.lit(0), drawn + marked - total), F.least(marked, drawn)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1.0) * (marked + 1.0) / (total + 2.0)).cast("long")))
    up = lambda k: (marked - k) * (drawn - k) / ((k + 1.0) * (total - marked - drawn + k + 1.0))  # noqa: E731  p(k+1) / p(k)
    point = lambda k, p: F.struct(k.cast("long").alias("k"), p.cast("double").alias("p"))
    grow = lambda xs, n, step: F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>")), xs, step)
    last = lambda acc: F.element_at(acc, -1)
    # Only as far as the probabilities matter: 12 standard deviations and some steps.
    spread = F.ceil(12 * F.sqrt(drawn * (marked / F.greatest(total, F.lit(1))) * (1 - marked / F.greatest(total, F.lit(1)))) + 12)
    right = grow(F.array(point(mode, F.lit(1.0))), F.least(high - mode, spread), lambda acc, _: F.concat(acc, F.array(point(last(acc)["k"] + 1, last(acc)["p"] * up(last(acc)["k"])))))
    left = grow(F.array(point(mode, F.lit(1.0))), F.least(mode - low, spread), lambda acc, _: F.concat(acc, F.array(point(last(acc)["k"] - 1, last(acc)["p"] / up(last(acc)["k"] - 1)))))
    chances = F.concat(F.reverse(F.slice(left, 2, 1 << 20)), right)
    mass = F.aggregate(chances, F.lit(0.0), lambda acc, x: acc + x["p"])
    walked = F.aggregate(chances, F.struct((u * mass).alias("left"), mode.cast("long").alias("k"), F.lit(False).alias("done")), lambda acc, x: F.struct(
        (acc["left"] - x["p"]).alias("left"), F.when(acc["done"], acc["k"]).otherwise(x["k"]).alias("k"), (acc["done"] | (acc["left"] <= x["p"])).alias("done")))
    return walked["k"]


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Rows (source, n) of block numbers to rows (source, shard, n), with exact sums of sources and even shards.

    A level of the tree halves every node at once. Within a node the sources are drawn one after the
    other, each from what the earlier ones left of the half: a fold over the node's row of quotas.
    """
    nodes = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"), F.col("n").cast("long").alias("n")))).alias("qs")).withColumn("shard", F.lit(0))
    levels = shards.bit_length() - 1
    for level in range(levels):
        total = F.aggregate("qs", F.lit(0).cast("long"), lambda acc, q: acc + q["n"])
        nodes = nodes.withColumn("total", total)
        start = F.struct(F.col("total").alias("rest"), F.floor(F.col("total") / 2).cast("long").alias("room"), F.array().cast("array<bigint>").alias("out"))

        def draw(acc, q):
            got = hypergeometric(acc["rest"], q["n"], acc["room"], unit(F.lit(level), F.col("shard"), q["s"], q["none"], seed=seed))
            return F.struct((acc["rest"] - q["n"]).alias("rest"), (acc["room"] - got).alias("room"), F.concat(acc["out"], F.array(got)).alias("out"))

        nodes = nodes.withColumn("left", F.aggregate("qs", start, draw)["out"])
        child = lambda pick, bit: F.struct((F.col("shard") * 2 + bit).alias("shard"), F.transform("qs", lambda q, i: F.struct(q["s"].alias("s"), q["none"].alias("none"), pick(q, i).alias("n"))).alias("qs"))
        nodes = nodes.select(F.explode(F.array(child(lambda q, i: F.get(F.col("left"), i), 0), child(lambda q, i: q["n"] - F.get(F.col("left"), i), 1))).alias("c")).select("c.*")
    return nodes.select("shard", F.explode("qs").alias("q")).select(F.when(~F.col("q.none"), F.col("q.s")).alias("source"), "shard", F.col("q.n").alias("n"))


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", key: str = "doc_id", shards: int = SHARDS, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs``: key, the columns ``carry``, size, source_size, target, taken and ``places``.

    ``places`` has for each time the row is taken its pass, shard and order within the shard.
    """
    sized = stage(docs.select(F.col(key), *carry, F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
                  .withColumn("u", unit(F.col(key), F.col("source"), F.col("size"), seed=seed)).withColumn("block", F.floor(F.col("u") * BLOCKS).cast("int")), "mixing")
    blocks = stage(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "mixing")
    plan = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")))
    plan = plan.withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")) \
               .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
    # The order of a source's blocks, and where each ends in words.
    b = blocks.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    w = Window.partitionBy("source").orderBy(unit(F.col("source"), F.col("block"), seed=seed + 1), "block")
    b = b.withColumn("place", F.row_number().over(w) - 1).withColumn("ends", F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    b = b.withColumn("n_blocks", F.count(F.lit(1)).over(Window.partitionBy("source")))
    # Whole in the last pass, or cut within the block: words still to take there.
    b = stage(b.withColumn("whole", F.col("ends") <= F.col("rest"))
              .withColumn("open", F.greatest(F.lit(0.0), F.least(F.col("words").cast("double"), F.col("rest") - (F.col("ends") - F.col("words")))))
              .withColumn("partly", ~F.col("whole") & (F.col("open") > 0)), "mixing")
    quotas = b.groupBy("source").agg((F.first("full") * F.first("n_blocks") + F.sum((F.col("whole") | F.col("partly")).cast("int"))).alias("n"))
    dealt = split_quotas(quotas, shards, seed)
    bounds = dealt.groupBy(F.col("source").alias("_source")).agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("ns")).select(
        "_source", F.aggregate("ns", F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["n"]))).alias("starts"))
    b = stage(b.join(bounds, F.col("source").eqNullSafe(F.col("_source"))).select(F.col("source").alias("_source"), F.col("block").alias("_block"), "source_size", "target", "full", "place", "n_blocks", "whole", "partly", "open", "starts"), "mixing")
    rows = sized.join(b, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    # One block per source is cut: its rows in hash order, up to the row that comes nearest to the target.
    inner = Window.partitionBy("_source", "_block").orderBy("u", key, *carry).rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.where("partly").withColumn("_ends", F.sum("size").over(inner)).withColumn("last", F.col("_ends") - F.col("size") / 2 <= F.col("open")).drop("_ends")
    rows = rows.where(~F.col("partly")).withColumn("last", F.col("whole")).unionByName(cut)
    times = F.col("full") + F.col("last").cast("int")
    order = lambda p: (F.col("n_blocks") * p + F.when(p < F.col("full"), F.pmod(F.col("place") + p * 7, F.col("n_blocks"))).otherwise(F.col("place"))).cast("long")
    shard = lambda at: F.least(F.lit(shards), F.size(F.filter("starts", lambda s: s <= at))) - 1
    places = F.transform(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>")), lambda p: F.struct(
        p.alias("pass"), shard(order(p)).alias("shard"), F.xxhash64(F.lit(seed + 2), F.col(key), p).alias("at")))
    return rows.select(key, *carry, "size", "source_size", "target", (F.col("size") * times).alias("taken"), places.alias("places"))

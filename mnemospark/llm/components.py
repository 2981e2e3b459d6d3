"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mnemospark.llm.staging import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, class)`` for every end of a link; the class is the smallest id reached.

    Each round gives every id the smallest class among its neighbours, then the class of its class
    (pointer jumping), so that chains shrink by half. Minima combine before the shuffle; a hub is one more
    summand, never a group in memory. A round is written to the shared folder.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b"))
    edges = stage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "components")
    now = stage(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("class")), "components")
    while True:
        around = (edges.join(now, edges["b"] == now["id"]).groupBy("a").agg(F.min("class").alias("near")))
        best = now.join(around, now["id"] == around["a"]).select("id", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        up = now.select(F.col("id").alias("up"), F.col("class").alias("top"))
        after = stage(best.join(up, best["class"] == up["up"], "left").select("id", "old", F.least("class", F.coalesce("top", "class")).alias("class")), "components")
        if after.where(F.col("old") != F.col("class")).isEmpty():
            return after.select("id", "class")
        now = after.select("id", "class")

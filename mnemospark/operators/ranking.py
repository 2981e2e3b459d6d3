"""Rank helpers: every ranking is by rounded score, then id, so results are repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mnemospark.session import durable

SCORE_DIGITS = 6


def rounded(score: Column) -> Column:
    return F.round(score, SCORE_DIGITS)


def top_k(hits: DataFrame, k: int | None, *, by: str = "query_id", score: str = "score",
          id_col: str = "id", rank: str = "rank") -> DataFrame:
    """Rank hits in each query and keep the first ``k``; ``None`` keeps all.

    ``row_number() <= k`` lets Spark trim each partition before the shuffle (WindowGroupLimit),
    so one hot query does not travel whole.
    """
    if k is None:
        return number_all(hits, [by], [F.desc(score), F.asc(id_col)], rank)
    order = W.partitionBy(by).orderBy(F.desc(score), F.asc(id_col))
    return hits.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def number_all(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number`` over every row of every key, for keys of any size.

    Rows are range-partitioned by key and order, so a hot key spans many tasks; each task numbers
    its own run and adds the count of the runs before it. The ranges are written out once, since
    a recomputed range partitioning may draw other borders.
    """
    ranged = durable(df.repartitionByRange(*[F.col(f"`{c}`").asc() for c in keys], *order)
                     .withColumn("_run", F.spark_partition_id()))
    sizes = ranged.groupBy(*keys, "_run").agg(F.count("*").alias("_in_run"))
    before = W.partitionBy(*keys).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_run", F.coalesce(F.sum("_in_run").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(*keys, "_run").orderBy(*order))
    return (ranged.withColumn(name, inside).join(starts, [*keys, "_run"])
            .withColumn(name, (F.col(name) + F.col("_start")).cast("int")).drop("_run", "_start"))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; trimmed map-side like ``top_k``."""
    return (df.withColumn("_nth", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
            .filter("_nth = 1").drop("_nth"))

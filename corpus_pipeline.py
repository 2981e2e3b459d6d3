"""From raw documents to token ids, in five stages.

Each stage reads what the one before has written and returns the columns of documents; the last adds
ids. Decisions take effect: rejected texts go, one text of each near group stays, personal data is
replaced, a text that the mix takes twice stands twice and one it does not take goes.

Ids may be null or repeated: decisions come back to their rows by ``ROW``, a 64-bit hash of all columns. Only rows
that are equal throughout share it, and of these it does not matter which one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mnemospark.llm import bpe, mixing, near_dedup, pii, quality
from mnemospark.llm.staging import stage

TOKENIZER = "word_bpe_49k.json"
ROW = "_row"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ROW``; which columns are null is part of the hash, since hashing passes over nulls."""
    return docs.withColumn(ROW, F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns]))


def single(rows: DataFrame, among: Column | None = None) -> DataFrame:
    """One of each set of equal rows; only rows where ``among`` holds if given. Only repeated rows are shuffled whole."""
    among = F.lit(True) if among is None else among
    repeated = stage(rows.where(among).groupBy(ROW).count().where("count > 1").select(ROW), "rows")
    if repeated.isEmpty():
        return rows
    return rows.join(repeated, ROW, "left_anti").unionByName(rows.join(repeated, ROW, "left_semi").dropDuplicates())


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that pass the limits and are no outlier of their language and source."""
    rows = keyed(docs)
    kept = quality.judge(rows, key=ROW).where("kept").select(ROW).distinct()
    return rows.join(kept, ROW, "left_semi").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each near group: that with the smallest id, null last."""
    rows = keyed(docs)
    groups = stage(near_dedup.near_classes(rows, key=ROW).where("size > 1").select(ROW, "class"), "near-groups")
    named = rows.select(ROW, "doc_id").join(groups, ROW)
    first = named.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first")).select("class", F.col(f"first.{ROW}").alias("stays"))
    gone = groups.join(first, "class").where(F.col(ROW) != F.col("stays")).select(ROW)
    # Equal rows with words are copies of one another too.
    return single(rows.join(gone, ROW, "left_anti"), F.col("text").rlike(near_dedup.HAS_WORDS)).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs, pii.train(docs)).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as often as the mix takes it, by shard and shuffled within."""
    rows = keyed(docs)
    places = mixing.mix(rows, carry=(ROW,)).select(ROW, F.explode("places").alias("place")).select(ROW, "place.shard", "place.at", "place.pass")
    mixed = single(rows).join(places, ROW)  # of equal rows each has places of its own
    return mixed.repartition(mixing.SHARDS, "shard").sortWithinPartitions("shard", "at", "doc_id", "pass", ROW).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text."""
    path = public_tokenizers.path(TOKENIZER)
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), path).select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: The estimates, signatures and networks of the stages are not SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Intermediate tables in the shared folder and small helpers of the operators here."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.session import ensure_checkpoint_dir

SPACES = r"\x20\x09-\x0D"  # fixed value: what separates words
WORD = rf"[^{SPACES}]+"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage: a lost executor costs only the tasks after this table. The folder is the
    shared one that the session names; its owner clears it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unit(*cols: Column | str, seed: int = 0) -> Column:
    """A number from [0, 1) that depends only on the columns and the seed."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)) * F.lit(2.0 ** -53)


def word_count(text: Column | str) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")

"""Session settings and the durable lineage cut used by iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SMALL_ROWS = 1_000_000  # most rows of a narrow table that travel to every task


def local_session(cpus: str | int = "*", app: str = "mnemospark", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for durable intermediate results.

    ``spark.checkpoint.dir`` names the shared folder on a cluster and always wins.
    A temporary folder is made up only for a local master, where driver and
    executors are one machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = os.path.join(tempfile.gettempdir(), f"mnemospark-{sc.applicationId}")
    sc.setCheckpointDir(made)
    return made


def few(hits: DataFrame) -> DataFrame:
    """Search results about to meet a large table: written out, counted, and broadcast if they are few.

    Spark estimates a result from the table it was searched in, and would shuffle that table for
    the join. The count is exact; beyond ``SMALL_ROWS`` the join is left to Spark.
    """
    return sized(durable(hits))


def sized(df: DataFrame) -> DataFrame:
    """Broadcast hint for a narrow table that is cheap to count, if it is small."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def spread(scan: DataFrame) -> DataFrame:
    """A file scan dealt out over all cores when it has fewer splits than that; else unchanged.

    For heavy work per row on few or unsplittable files. Only for plain scans: asking a plan
    with shuffles for its partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet below the checkpoint folder, whose owner clears it. Joins see its size, unlike that of ``durable``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

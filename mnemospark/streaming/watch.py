"""Watching a folder by comparing its listing with a ledger, and late duplicates of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from mnemospark.plans.sync import CHUNK_SCHEMA, sync
from mnemospark.session import durable
from mnemospark.sources.keyed import KeyedTable
from mnemospark.sources.objects import load_objects, scan_objects

POLL_SECONDS = 10
FILE_SCHEMA = "path string, etag string, status string"


def chunk_table(spark: SparkSession, root: str, **layout) -> KeyedTable:
    """The chunks below ``root``, by path."""
    return KeyedTable(spark, f"{root.rstrip('/')}/chunks", CHUNK_SCHEMA, "source_path", **layout)


def file_table(spark: SparkSession, root: str, **layout) -> KeyedTable:
    """The ledger below ``root``: every object seen, its ETag, and what came of it."""
    return KeyedTable(spark, f"{root.rstrip('/')}/files", FILE_SCHEMA, "path", **layout)


def poll(spark: SparkSession, source: str, root: str, *, on_change: Callable[[DataFrame], None] | None = None,
         retain: int | None = None, layout: dict | None = None, **options) -> bool:
    """Bring the chunks and the ledger below ``root`` in line with the objects of ``source``; whether anything changed.

    Listing and ledger are compared; only created and updated objects are opened, and only the slices of changed
    paths are written. The chunks come first: if the ledger is not reached, the next poll does the same again.
    """
    chunks, files = chunk_table(spark, root, **layout or {}), file_table(spark, root, **layout or {})
    done = sync(scan_objects(spark, source, with_content=False), chunks.read(), files=files.read(),
                load=lambda wanted: load_objects(spark, source, wanted), **options)
    changed = done.changes.filter(F.col("change") != "unchanged")
    if changed.isEmpty():
        return False
    chunks.update(done.stale, durable(done.fresh))
    touched = changed.select("path")
    files.update(touched, durable(done.files.join(touched, "path", "left_semi")))
    if retain is not None:
        chunks.retain(retain)
        files.retain(retain)
    if on_change is not None:
        on_change(changed)
    return True


def watch_objects(spark: SparkSession, source: str, root: str, checkpoint: str, *, interval: int = POLL_SECONDS,
                  once: bool = False, **options) -> StreamingQuery:
    """Poll ``source`` every ``interval`` seconds, or once.

    The stream's source is the clock alone, so a deletion is noticed without any file arriving.
    """
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    writer = (ticks.writeStream.foreachBatch(lambda _, batch_id: poll(spark, source, root, **options) and None)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{interval} seconds")
    return writer.start()


def drop_duplicates(stream: DataFrame, keys: list[str], time_col: str, delay: str = "10 minutes") -> DataFrame:
    """First event per key within the watermark; zone-free times are taken as session time."""
    return (stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
            .withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys))

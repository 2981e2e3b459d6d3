"""Object events: parsing notifications and applying them to the chunk table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from mnemospark.operators.tables import last_per_key
from mnemospark.plans.sync import chunk_objects
from mnemospark.session import durable, few, sized
from mnemospark.sources.keyed import KeyedTable

_RECORDS = "struct<Records:array<struct<eventName:string,s3:struct<object:struct<key:string>>>>>"


def parse_object_events(bodies: DataFrame, prefix: str = "", *, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(keep..., action, path)`` with action ``upsert``, ``delete``, ``ignored`` or ``malformed``.

    Bodies are JSON, possibly wrapped in a notification whose ``Message`` is the JSON text.
    Keys outside the prefix, unknown events and records without a key are ignored; a body that is
    no JSON object is malformed. Works on batch and streaming input.
    """
    outer = F.from_json("body", "struct<Message:string>")
    inner = F.coalesce(outer["Message"], F.col("body"))
    parsed = bodies.select(*keep, F.try_parse_json(inner).alias("_v"), F.from_json(inner, _RECORDS)["Records"].alias("_r"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    rows = parsed.select(*keep, is_object.alias("_ok"), F.explode_outer("_r").alias("r"))
    name, path = F.col("r.eventName"), F.col("r.s3.object.key")
    action = (F.when(~F.col("_ok"), "malformed")
              .when(path.isNull() | ~path.startswith(prefix), "ignored")
              .when(name.startswith("ObjectCreated"), "upsert")
              .when(name.startswith("ObjectRemoved"), "delete").otherwise("ignored"))
    return rows.select(*keep, action.alias("action"), path.alias("path"))


def event_changes(chunks: DataFrame, events: DataFrame, objects: DataFrame, *, seq: str = "seq",
                  **chunking) -> tuple[DataFrame, DataFrame]:
    """What ``events(seq, action, path)`` do to a chunk table: paths whose chunks go, and chunks that come.

    Only the last event of a path counts. An upsert whose (path, ETag) is already present, or whose
    object has gone, changes nothing; otherwise all chunks of the path are replaced.
    """
    last = durable(last_events(events, seq))
    removed = last.filter("action = 'delete'").select("path")
    touched = sized(last.filter("action = 'upsert'").select("path"))
    stored = chunks.select(F.col("source_path").alias("path"), "etag").join(touched, "path", "left_semi").distinct()
    changed = objects.join(touched, "path", "left_semi").join(stored, ["path", "etag"], "left_anti")
    fresh = chunk_objects(changed, **chunking)
    return few(changed.select("path").unionByName(removed).select(F.col("path").alias("source_path"))), fresh


def last_events(events: DataFrame, seq: str = "seq") -> DataFrame:
    """The last upsert or delete of each path."""
    return last_per_key(events.filter(F.col("action").isin("upsert", "delete")).select("path", "action", seq), ["path"], seq)


def apply_events(chunks: DataFrame, events: DataFrame, objects: DataFrame, *, seq: str = "seq",
                 **chunking) -> DataFrame:
    """Chunk table after ``events(seq, action, path)``."""
    stale, fresh = event_changes(chunks, events, objects, seq=seq, **chunking)
    return chunks.join(stale, "source_path", "left_anti").unionByName(fresh)


def event_sink(table: KeyedTable, read_objects: Callable[[], DataFrame], prefix: str = "", *, seq: str = "seq",
               dead_letters: str | None = None, stream: str | None = None, retain: int | None = None,
               **chunking) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that applies the events of each batch to a chunk table.

    A batch reads and rewrites only the slices of the paths it names. A batch that is sent again changes
    nothing; a stream with a new checkpoint goes on from the table as it is. Malformed bodies go to
    ``dead_letters``, a folder per stream and batch. ``retain`` keeps that many commits after each batch.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        source = stream or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        if table.applied(source, batch_id):
            return
        events = parse_object_events(batch, prefix, keep=(seq, "body"))
        if dead_letters is not None:
            bad = events.filter("action = 'malformed'").select(seq, "body").distinct()
            bad.write.mode("overwrite").parquet(f"{dead_letters}/stream={source}/batch={batch_id}")
        last = durable(last_events(events, seq))
        near = table.read(table.touched(last.select("path")))
        stale, fresh = event_changes(near, last, read_objects(), seq=seq, **chunking)
        table.update(stale, durable(fresh), stream=source, batch=batch_id)
        if retain is not None:
            table.retain(retain)
    return apply

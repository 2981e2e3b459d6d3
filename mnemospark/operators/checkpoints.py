"""Checkpoint log with pending writes, parent chains and forks.

Checkpoints: ``thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type, checkpoint,
metadata MAP<STRING,STRING>, created_at``. Writes: ``thread_id, checkpoint_ns, checkpoint_id,
task_id, idx, task_path, channel, type, value, created_at``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.functions.values import metadata_equals, typed_metadata
from mnemospark.operators.ranking import first_per_key
from mnemospark.operators.tables import insert_new, narrowed, upsert
from mnemospark.session import written

KEY = ["thread_id", "checkpoint_ns", "checkpoint_id"]
WRITE_KEY = [*KEY, "task_id", "idx"]

DIRECT_LINKS = 200_000  # up to which a lineage is walked without stops
STOP_EVERY = 16
LONG_LEG = 1024  # links between two stops that chance does not leave

# Channels with a fixed position, whose writes replace earlier ones.
SPECIAL_CHANNELS = {"__error__": -1, "__scheduled__": -2, "__interrupt__": -3, "__resume__": -4}


def put_checkpoint(checkpoints: DataFrame, new: DataFrame, *, seq: str | None = None) -> DataFrame:
    """Checkpoints after an upsert by thread, namespace and id."""
    return upsert(checkpoints, new, KEY, [c for c in checkpoints.columns if c not in KEY], seq=seq)


def write_index(channel: Column | str, position: Column | str) -> Column:
    """Fixed index of a special channel, else the position of the write in its call."""
    c = F.col(channel) if isinstance(channel, str) else channel
    p = F.col(position) if isinstance(position, str) else position
    out = p.cast("int")
    for name, idx in SPECIAL_CHANNELS.items():
        out = F.when(c == name, F.lit(idx)).otherwise(out)
    return out


def put_writes(writes: DataFrame, new: DataFrame, *, call: str = "call", pos: str = "pos") -> DataFrame:
    """Pending writes after a batch of calls, applied in ``call`` order.

    A call whose channels are all special replaces what is there; any other call only fills gaps.
    ``new`` has the write columns but ``idx``, with ``call`` (rising number of the put) and ``pos``.
    """
    special = F.col("channel").isin(*SPECIAL_CHANNELS)
    per_call = new.groupBy(call).agg(F.min(special).alias("_replaces"))
    ready = (new.join(per_call, call).withColumn("idx", write_index("channel", pos))
             .withColumn("_order", F.struct(F.col(call), F.col(pos))))
    rest = [c for c in writes.columns if c not in WRITE_KEY]
    # Per key: the last replacing write if there is one, and the first write for a new key.
    folded = ready.groupBy(*WRITE_KEY).agg(
        F.max_by(F.when(F.col("_replaces"), F.struct(*rest)),
                 F.when(F.col("_replaces"), F.col("_order"))).alias("_last"),
        F.min_by(F.struct(*rest), F.col("_order")).alias("_first"))
    replacing = folded.filter("_last IS NOT NULL").select(*WRITE_KEY, "_last.*")
    filling = folded.filter("_last IS NULL").select(*WRITE_KEY, "_first.*")
    return insert_new(upsert(writes, replacing, WRITE_KEY, rest), filling, WRITE_KEY)


def with_writes(checkpoints: DataFrame, writes: DataFrame) -> DataFrame:
    """One row per checkpoint and pending write (one row with nulls where there is none).

    A single join replaces a lookup per checkpoint; rows stay long so a checkpoint with very many
    writes is not gathered into one value.
    """
    pending = writes.select(*KEY, "task_id", "idx", "channel", F.col("value").alias("write_value"))
    return checkpoints.join(narrowed(pending, checkpoints, KEY), KEY, "left")


def list_checkpoints(checkpoints: DataFrame, *, thread_id: str | None = None,
                     checkpoint_ns: str | None = None, metadata: Mapping[str, str] | None = None,
                     before: str | None = None, limit: int | None = None,
                     writes: DataFrame | None = None) -> DataFrame:
    """Newest first. ``metadata`` maps keys to JSON-encoded values; ``before`` is strict."""
    kept = checkpoints
    if thread_id is not None:
        kept = kept.filter(F.col("thread_id") == thread_id)
    if checkpoint_ns is not None:
        kept = kept.filter(F.col("checkpoint_ns") == checkpoint_ns)
    if metadata:
        kept = kept.filter(metadata_equals("metadata", dict(metadata)))
    if before is not None:
        kept = kept.filter(F.col("checkpoint_id") < before)
    newest = [F.desc("checkpoint_id"), F.asc("thread_id"), F.asc("checkpoint_ns")]
    if limit is not None:
        kept = kept.orderBy(*newest).limit(limit)
    if writes is not None:
        kept = with_writes(kept, writes)
        newest = [*newest, F.asc("task_id"), F.asc("idx")]
    return kept.orderBy(*newest)


def latest_checkpoints(checkpoints: DataFrame) -> DataFrame:
    """Latest checkpoint of every thread and namespace."""
    return first_per_key(checkpoints, ["thread_id", "checkpoint_ns"], [F.desc("checkpoint_id")])


def get_checkpoint(checkpoints: DataFrame, asked: DataFrame, writes: DataFrame | None = None) -> DataFrame:
    """Checkpoint of each asked ``(thread_id, checkpoint_ns, checkpoint_id)``; a null id means the latest."""
    pair = ["thread_id", "checkpoint_ns"]
    exact = checkpoints.join(asked.filter("checkpoint_id IS NOT NULL").select(*KEY), KEY, "left_semi")
    open_ = checkpoints.join(asked.filter("checkpoint_id IS NULL").select(*pair), pair, "left_semi")
    found = exact.unionByName(latest_checkpoints(open_)).dropDuplicates(KEY)
    return found if writes is None else with_writes(found, writes)


def delete_threads(table: DataFrame, threads: DataFrame) -> DataFrame:
    """Rows of other threads; used on checkpoints and on writes."""
    return table.join(threads.select("thread_id"), "thread_id", "left_anti")


def time_travel(checkpoints: DataFrame, metadata: Mapping[str, str]) -> DataFrame:
    """Per thread and namespace, the newest checkpoint with the given metadata: where to fork from."""
    return latest_checkpoints(checkpoints.filter(metadata_equals("metadata", dict(metadata))))


def fork(origins: DataFrame, new_id: Column) -> DataFrame:
    """Copies of checkpoints under a new id, with the origin as parent."""
    return origins.withColumn("parent_checkpoint_id", F.col("checkpoint_id")).withColumn("checkpoint_id", new_id)


def _walk(reach: DataFrame, jump: DataFrame, longest: int, legs: bool = False) -> DataFrame:
    """``(start, at, distance)`` of ``reach`` and of all that lies up to ``longest`` links behind it.

    The links ``jump(from, to, length)`` are doubled each round, so n links take log2(n) rounds; every round is written out.
    """
    parts, span = [written(reach)], 1
    jump = written(jump)
    while span <= longest and not jump.isEmpty():
        # Each part once more, from where it ended: they hold all that is less than ``span`` links away.
        known = reduce(DataFrame.unionByName, parts)
        further = known.join(jump.withColumnRenamed("from", "at"), "at").select(
            "start", F.col("to").alias("at"), (F.col("distance") + F.col("length")).alias("distance"))
        if legs and span >= LONG_LEG:  # a cycle without a stop: what is known is not entered again
            further = further.groupBy("start", "at").agg(F.min("distance").alias("distance")).join(known, ["start", "at"], "left_anti")
        parts.append(written(further))
        second = jump.select(F.col("from").alias("to"), F.col("to").alias("_end"), F.col("length").alias("_more"))
        jump = written(jump.join(second, "to").select("from", F.col("_end").alias("to"), (F.col("length") + F.col("_more")).alias("length")))
        span *= 2
    return reduce(DataFrame.unionByName, parts)


def lineage(checkpoints: DataFrame, starts: DataFrame) -> DataFrame:
    """``(thread_id, checkpoint_ns, start_id, checkpoint_id, distance)`` up the parent links.

    Checkpoints are numbered, so that rounds move numbers. Of many links, one checkpoint of ``STOP_EVERY`` and the starts are
    stops: walks go from each stop to the next, then from the starts over stops only, and both are put together. So only a
    few rounds touch all links. Parents are followed whatever their ids; a cycle ends where an id would repeat.
    """
    pair = ["thread_id", "checkpoint_ns"]
    checkpoints = narrowed(checkpoints, starts, pair)
    numbers = written(checkpoints.select(*KEY).distinct().withColumn("n", F.monotonically_increasing_id()))
    parents = checkpoints.filter("parent_checkpoint_id IS NOT NULL").select(*KEY, "parent_checkpoint_id").distinct()
    links = written(parents.join(numbers.withColumnRenamed("n", "from"), KEY)
                    .select(*pair, F.col("parent_checkpoint_id").alias("checkpoint_id"), "from")
                    .join(numbers.withColumnRenamed("n", "to"), KEY).select("from", "to", F.lit(1).alias("length")))
    first = written(starts.select(*KEY).distinct().join(numbers, KEY).select(F.col("n").alias("start"), F.col("n").alias("at"), F.lit(0).alias("distance")))
    longest = checkpoints.groupBy(*pair).count().agg(F.max("count")).first()[0] or 0
    if links.limit(DIRECT_LINKS + 1).count() <= DIRECT_LINKS:
        reach = _walk(first, links, longest)
    else:
        marked = links.join(first.select(F.col("start").alias("from"), F.lit(True).alias("begins")).distinct(), "from", "left").withColumn(
            "stops", F.coalesce("begins", F.xxhash64("from") % STOP_EVERY == 0))
        marked = written(marked.select("from", "to", "length", "stops"))
        stops = marked.filter("stops")
        legs = written(_walk(stops.select(F.col("from").alias("start"), F.col("to").alias("at"), F.col("length").alias("distance")),
                             marked.filter("NOT stops").drop("stops"), longest, legs=True))
        between = legs.join(stops.select(F.col("from").alias("at")).distinct(), "at", "left_semi")
        passed = _walk(first, between.select(F.col("start").alias("from"), F.col("at").alias("to"), F.col("distance").alias("length")), longest)
        passed = written(passed.groupBy("start", "at").agg(F.min("distance").alias("distance")))
        behind = passed.withColumnRenamed("distance", "before").join(legs.withColumnsRenamed({"at": "end", "start": "at"}), "at").select(
            "start", F.col("end").alias("at"), (F.col("before") + F.col("distance")).alias("distance"))
        reach = passed.unionByName(behind)
    nearest = reach.groupBy("start", "at").agg(F.min("distance").alias("distance"))
    names = numbers.select(F.col("n").alias("at"), *KEY)
    start_names = first.select("start").distinct().join(numbers.withColumnRenamed("n", "start"), "start").select("start", F.col("checkpoint_id").alias("start_id"))
    return nearest.join(names, "at").join(start_names, "start").select(*KEY, "start_id", "distance")


def migrate_metadata(old: DataFrame, existing_new: DataFrame, *, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows to add in typed form, and a one-row report ``(scanned, migrated)``.

    Rows whose key is already migrated are skipped. A dry run counts and adds nothing.
    """
    fresh = old.join(existing_new.select(*KEY), KEY, "left_anti")
    report = old.agg(F.count("*").alias("scanned")).select(
        "scanned", fresh.agg(F.count("*").alias("migrated")).scalar().alias("migrated"))
    rows = fresh.withColumn("metadata", typed_metadata("metadata"))
    return (rows.limit(0) if dry_run else rows), report

"""Keyed-table operations: fetch, delete, upsert, ordered lookup, expiry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.operators.ranking import number_all


def get_by_ids(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows with the asked ids; missing ids are dropped, repeated ids count once."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(id_col)), id_col, "left_semi")


def delete_ids(df: DataFrame, ids: DataFrame | Sequence | None = None, id_col: str = "id") -> DataFrame:
    """Rows that remain; no ids at all (``None`` or an empty list) deletes every row."""
    if ids is None or (not isinstance(ids, DataFrame) and not ids):
        return df.limit(0)
    if not isinstance(ids, DataFrame):
        kind = df.schema[id_col].dataType.simpleString()
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], f"`{id_col}` {kind}")
    return df.join(ids.select(F.col(ids.columns[0]).alias(id_col)), id_col, "left_anti")


def delete_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_anti")


def last_per_key(updates: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Last write per key. An aggregate, so a hot key is combined before the shuffle."""
    rest = [c for c in updates.columns if c not in keys]
    picked = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r"))
    return picked.select(*keys, "_r.*")


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], set_cols: Sequence[str],
           set_on_insert_cols: Sequence[str] = (), *, seq: str | None = None) -> DataFrame:
    """New content of ``base`` after keyed updates.

    ``set_cols`` take the last update per key, ``set_on_insert_cols`` only apply to new keys and
    take the first update. Without ``seq``, updates must be unique per key. ``base`` is read twice
    (the second time its keys only) instead of being shuffled for a full outer join: when the
    updates are small, both joins become broadcast joins and ``base`` stays where it is.
    """
    keys, set_cols, on_insert = list(keys), list(set_cols), list(set_on_insert_cols)
    if seq is not None:
        aggs = [F.max_by(F.struct(*set_cols), F.col(seq)).alias("_set")] if set_cols else []
        aggs += [F.min_by(F.struct(*on_insert), F.col(seq)).alias("_ins")] if on_insert else []
        aggs = aggs or [F.lit(True).alias("_any")]
        updates = updates.groupBy(*keys).agg(*aggs)
        updates = updates.select(*keys, *[F.col(f"_set.`{c}`").alias(c) for c in set_cols],
                                 *[F.col(f"_ins.`{c}`").alias(c) for c in on_insert])
    else:
        updates = updates.select(*keys, *set_cols, *on_insert)
    marked = updates.select(*keys, *[F.col(f"`{c}`").alias(f"_new_{c}") for c in set_cols],
                            F.lit(True).alias("_hit"))
    kept = base if not set_cols else base.join(marked, keys, "left").select(*[
        (F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(f"`{c}`")).alias(c)
         if c in set_cols else F.col(f"`{c}`")) for c in base.columns])
    known = base.select(*keys).join(updates.select(*keys), keys, "left_semi")
    fresh = updates.join(known, keys, "left_anti").select(*[
        (F.col(f"`{c}`") if c in updates.columns else F.lit(None).cast(base.schema[c].dataType).alias(c))
        for c in base.columns])
    return kept.unionByName(fresh)


def insert_new(base: DataFrame, rows: DataFrame, keys: Sequence[str], *, seq: str | None = None) -> DataFrame:
    """Append rows whose key is not present yet; the first of repeated new keys wins."""
    others = [c for c in base.columns if c not in keys]
    return upsert(base, rows, keys, [], others, seq=seq)


def narrowed(table: DataFrame, asked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a large table that an outer join from ``asked`` can meet.

    A left join cannot broadcast its left side; this semi join can, so few asked keys leave the
    table where it is and only the matching rows go into the left join.
    """
    return table.join(asked.select(*keys), list(keys), "left_semi")


def lookup_in_order(asked: DataFrame, table: DataFrame, key: str, *, pos: str = "pos") -> DataFrame:
    """``mget``: one row per asked position, nulls and ``found = false`` for missing keys."""
    body = narrowed(table, asked, [key]).withColumn("_found", F.lit(True))
    return (asked.join(body, key, "left")
            .withColumn("found", F.coalesce(F.col("_found"), F.lit(False))).drop("_found"))


def asked_keys(df: DataFrame, keys: Column | str, key: str = "key") -> DataFrame:
    """One row per asked key with its position, from an array column."""
    return df.select(*[c for c in df.columns if c != keys], F.posexplode(keys).alias("pos", key))


def expire(items: DataFrame, ttl_seconds: float, now: Column, col: str = "updated_at") -> DataFrame:
    """Rows still alive: touched less than ``ttl_seconds`` before ``now``; undated rows never expire."""
    limit = now - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return items.filter(F.col(col).isNull() | (F.col(col) > limit))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, for uniqueness checks."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def push_in_order(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column], *, at: str = "at") -> DataFrame:
    """``base(keys, at, ...)`` with the ``new`` rows appended to the list of their key, in ``order``.

    Lists are rows with a position from 0, so that a list of any length is spread over tasks; a key without
    a list gets one.
    """
    keys = list(keys)
    sizes = narrowed(base.select(*keys, at), new.select(*keys).distinct(), keys).groupBy(*keys).agg((F.max(at) + 1).alias("_size"))
    numbered = number_all(new, keys, list(order), "_n").join(sizes, keys, "left")
    place = (F.coalesce(F.col("_size"), F.lit(0)) + F.col("_n") - 1).cast(base.schema[at].dataType)
    return base.unionByName(numbered.withColumn(at, place).select(*base.columns))

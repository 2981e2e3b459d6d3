"""The keyed table: updates by slice, replay, old commits, plans and retention."""

import os
import random

import pytest
from helpers import rows

from mnemospark.sources.keyed import KeyedTable

SCHEMA = "k string, v int"


def made(spark, tmp_path, **more):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, "k", **{"slices": 16, "buckets": 4} | more)


def frame(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "k string")


def bytes_below(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_updates_equal_a_dictionary(spark, tmp_path):
    table, rng, held, snapshots = made(spark, tmp_path), random.Random(4), {}, [{}]
    for batch in range(6):
        stale = rng.sample([f"k{i}" for i in range(40)], 8) if batch != 3 else list(held)  # the fourth batch empties the table
        fresh = {k: [rng.randrange(100) for _ in range(rng.randint(0, 3))] for k in stale} if batch != 3 else {}
        table.update(keys(spark, stale), frame(spark, [(k, v) for k, vs in fresh.items() for v in vs]), stream="s", batch=batch)
        held = {k: v for k, v in held.items() if k not in stale} | {k: v for k, v in fresh.items() if v}
        snapshots.append(dict(held))
    flat = lambda d: sorted([(k, v) for k, vs in d.items() for v in vs], key=str)
    assert rows(table.read()) == flat(held)
    for commit, then in enumerate(snapshots[1:], 1):
        assert rows(table.read(commit=commit)) == flat(then)
    # Another object over the same folder sees the same, and other numbers are refused.
    assert rows(made(spark, tmp_path).read()) == flat(held)
    with pytest.raises(ValueError):
        made(spark, tmp_path, slices=8)


def test_a_batch_counts_once(spark, tmp_path):
    table = made(spark, tmp_path)
    table.update(keys(spark, []), frame(spark, [("a", 1)]), stream="s", batch=0)
    table.update(keys(spark, ["a"]), frame(spark, [("a", 2)]), stream="s", batch=1)
    assert table.update(keys(spark, ["a"]), frame(spark, [("a", 3)]), stream="s", batch=1) == []
    assert table.update(keys(spark, ["a"]), frame(spark, [("a", 3)]), stream="s", batch=0) == []
    table.update(keys(spark, []), frame(spark, []), stream="t", batch=0)  # an empty batch is remembered as well
    assert rows(table.read()) == [("a", 2)] and table.applied("t", 0) and not table.applied("t", 1) and table.last_commit() == 3
    table.update(keys(spark, []), frame(spark, []))
    assert table.last_commit() == 3


def test_null_and_odd_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "it's a table"), SCHEMA, "k", slices=2, buckets=2)
    table.update(keys(spark, []), frame(spark, [(None, 1), ("", 2), ("ü'\\", 3), ("x" * 10_000, 4)]))
    table.update(keys(spark, ["", None, "ü'\\"]), frame(spark, [("", 5)]))
    # No key equals null, so rows without a key stay.
    assert rows(table.read(), "v") == [1, 4, 5]


def test_only_touched_slices_are_written_and_read(spark, tmp_path):
    table = made(spark, tmp_path, slices=32)
    table.update(keys(spark, []), frame(spark, [(f"key {i}", i) for i in range(20_000)]))
    whole = bytes_below(tmp_path / "table" / "data")
    touched = table.update(keys(spark, ["key 5"]), frame(spark, [("key 5", -5)]))
    assert len(touched) == 1 and bytes_below(tmp_path / "table" / "data") - whole < whole / 16
    assert table.read(touched).count() < 20_000 / 16 and table.read().count() == 20_000
    assert table.read().where("k = 'key 5'").first().v == -5


def test_joins_by_key_do_not_move_the_table(spark, tmp_path):
    table = made(spark, tmp_path, buckets=4)
    table.update(keys(spark, []), frame(spark, [(f"key {i}", i) for i in range(1000)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = keys(spark, ["key 1"]).repartition(4, "k")
        plan = table.read().join(side, "k", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "Bucketed: true" in scan and plan.count("Exchange hashpartitioning") == 1
    moved = plan[plan.index("Exchange hashpartitioning"):]
    assert "FileScan" not in moved  # what is exchanged is the keys


def test_retention_drops_what_no_kept_commit_sees(spark, tmp_path):
    table = made(spark, tmp_path)
    for batch in range(5):
        table.update(keys(spark, ["a"]), frame(spark, [("a", batch), (f"once {batch}", batch)]), stream="s", batch=batch)
    before = bytes_below(tmp_path / "table" / "data")
    now = rows(table.read())
    fourth = rows(table.read(commit=4))
    assert table.retain(2) > 0 and bytes_below(tmp_path / "table" / "data") < before
    assert rows(table.read()) == now and rows(table.read(commit=4)) == fourth
    with pytest.raises(ValueError):
        table.read(commit=3)
    assert table.retain(2) == 0 and table.applied("s", 4) and table.last_commit() == 5
    table.update(keys(spark, [k for k, _ in now]), frame(spark, []), stream="s", batch=5)
    assert table.retain(1) > 0 and table.read().count() == 0 and table.applied("s", 5)
    assert bytes_below(tmp_path / "table" / "data") == 0

"""Agent-memory tables kept as streaming state: latest values, chat history, exact cache and ledger.

All need the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``). Late rows are put where their
``seq`` belongs, so the state after a stream equals the batch operators over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "key string, value string, previous string"


class LatestValue(StatefulProcessor):
    """Latest value per key by ``seq``; a key not written for ``ttl_ms`` is forgotten.

    A null value deletes; its ``seq`` stays, so that an older write that comes later changes nothing.
    """

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", "seq bigint, value string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at, before = self.value.get() if self.value.exists() else (None, None)
        last = None
        for batch in rows:
            newest = batch.loc[batch["seq"].idxmax()]
            if last is None or newest["seq"] > last["seq"]:
                last = newest
        if last is None or (at is not None and int(last["seq"]) <= at):
            return
        self.value.update((int(last["seq"]), last["value"]))
        yield pd.DataFrame({"key": [key[0]], "value": [last["value"]], "previous": [before]})

    def close(self) -> None:
        pass


def keyed_state(stream: DataFrame, ttl_seconds: float | None = None) -> DataFrame:
    """``(key, value, previous)`` changes of a stream of ``(key, seq, value)`` puts.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    ttl = None if ttl_seconds is None else int(ttl_seconds * 1000)
    return stream.groupBy("key").transformWithStateInPandas(
        statefulProcessor=LatestValue(ttl), outputStructType=OUTPUT, outputMode="Update",
        timeMode="None" if ttl is None else "ProcessingTime")


# ---- chat history: the last messages of a session ------------------------------------------

HISTORY = "session_id string, messages array<struct<seq:bigint,message:string>>"


class LastMessages(StatefulProcessor):
    """The ``size`` messages of a session with the highest ``seq``, as a list."""

    def __init__(self, size: int, ttl_ms: int | None):
        self.size, self.ttl_ms = size, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.messages = handle.getListState("messages", "seq bigint, message string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = [(int(s), m) for s, m in self.messages.get()] if self.messages.exists() else []
        held = dict(before)
        for batch in rows:  # the same message sent again changes nothing, a corrected one replaces it
            held.update(zip(batch["seq"].astype(int), batch["message"]))
            held = dict(sorted(held.items())[-self.size:])
        now = sorted(held.items())
        if now != before:
            self.messages.put(now)
            yield pd.DataFrame({"session_id": [key[0]], "messages": [[{"seq": s, "message": m} for s, m in now]]})

    def close(self) -> None:
        pass


def history_state(stream: DataFrame, size: int, ttl_seconds: float | None = None) -> DataFrame:
    """``(session_id, messages)`` whenever the last ``size`` messages of a session change.

    ``stream(session_id, seq, message)``; a session that nothing is added to for ``ttl_seconds`` is forgotten.
    """
    if size < 1:
        raise ValueError("a history holds one message at least")
    ttl = None if ttl_seconds is None else int(ttl_seconds * 1000)
    return stream.select("session_id", "seq", "message").groupBy("session_id").transformWithStateInPandas(
        statefulProcessor=LastMessages(size, ttl), outputStructType=HISTORY, outputMode="Update",
        timeMode="None" if ttl is None else "ProcessingTime")


# ---- exact cache: one map of models per prompt ---------------------------------------------

CACHE = "prompt string, llm string, seq bigint, return_val string, hit boolean"


class ExactCache(StatefulProcessor):
    """Answers of a prompt by model; within a batch, puts and lookups take effect in the order of ``seq``."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.answers = handle.getMapState("answers", "llm string", "seq bigint, return_val string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asked = []
        for row in pd.concat(rows).sort_values("seq", kind="stable").itertuples():
            model = (row.llm,)
            held = self.answers.getValue(model) if self.answers.containsKey(model) else None
            if not row.put:
                asked.append((key[0], row.llm, int(row.seq), None if held is None else held[1], held is not None))
            elif held is None or held[0] <= row.seq:
                self.answers.updateValue(model, (int(row.seq), row.return_val))
        if asked:
            yield pd.DataFrame(asked, columns=["prompt", "llm", "seq", "return_val", "hit"])

    def close(self) -> None:
        pass


def cache_state(stream: DataFrame, ttl_seconds: float | None = None) -> DataFrame:
    """``(prompt, llm, seq, return_val, hit)`` for each lookup of a stream of puts and lookups.

    ``stream(prompt, llm, seq, return_val, put)``; a lookup is a row whose ``put`` is false. An answer that was
    put longer than ``ttl_seconds`` ago is a miss.
    """
    ttl = None if ttl_seconds is None else int(ttl_seconds * 1000)
    return stream.select("prompt", "llm", "seq", "return_val", "put").groupBy("prompt").transformWithStateInPandas(
        statefulProcessor=ExactCache(ttl), outputStructType=CACHE, outputMode="Append",
        timeMode="None" if ttl is None else "ProcessingTime")


# ---- index ledger: keys with a time, and a notice when they run out ------------------------

LEDGER = "namespace string, key string, group_id string, updated_at timestamp, change string"


class Ledger(StatefulProcessor):
    """Keys of one part of a namespace: ``updated_at`` and group, with one timer for the key that expires first."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.keys = handle.getMapState("keys", "key string", "at bigint, group_id string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = []
        for row in pd.concat(rows).sort_values("at", kind="stable").itertuples():
            name = (row.key,)
            held = self.keys.getValue(name) if self.keys.containsKey(name) else None
            if held is None or held[0] <= row.at:  # an older update that comes late changes nothing
                self.keys.updateValue(name, (int(row.at), row.group_id))
                out.append((row.key, row.group_id, int(row.at), "indexed"))
        self._wake()
        yield self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        gone = [(k[0], v[1], v[0], "expired") for k, v in self.keys.iterator() if v[0] + self.ttl_ms <= now]
        for k, *_ in gone:
            self.keys.removeKey((k,))
        self._wake()
        yield self._rows(key, gone)

    def _wake(self) -> None:
        """Set the timer for the oldest key, and no other."""
        times = [v[0] for _, v in self.keys.iterator()]
        wanted = min(times) + self.ttl_ms if times else None
        for timer in list(self.handle.listTimers()):
            if timer != wanted:
                self.handle.deleteTimer(timer)
        if wanted is not None:
            self.handle.registerTimer(wanted)

    @staticmethod
    def _rows(key, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["key", "group_id", "at", "change"])
        return pd.DataFrame({"namespace": [key[0]] * len(out), "key": out["key"], "group_id": out["group_id"],
                             "updated_at": pd.to_datetime(out["at"], unit="ms"), "change": out["change"]})

    def close(self) -> None:
        pass


def ledger_state(stream: DataFrame, ttl_seconds: float, delay: str = "10 minutes", *, parts: int = 1024) -> DataFrame:
    """``(namespace, key, group_id, updated_at, change)``: a row when a key is indexed and one when it expires.

    ``stream(namespace, key, group_id, updated_at)`` with event times. A key expires when the stream's watermark has
    passed its last update by ``ttl_seconds``. The keys of a namespace are dealt over ``parts`` states, so that a large
    namespace is not one.
    """
    timed = (stream.withColumn("updated_at", F.col("updated_at").cast("timestamp")).withWatermark("updated_at", delay)
             .withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
             .withColumn("at", F.unix_millis("updated_at")))
    return timed.select("namespace", "part", "key", "group_id", "at", "updated_at").groupBy("namespace", "part").transformWithStateInPandas(
        statefulProcessor=Ledger(int(ttl_seconds * 1000)), outputStructType=LEDGER, outputMode="Append", timeMode="EventTime")

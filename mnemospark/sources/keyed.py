"""A keyed table on plain Parquet of which an update rewrites only the slices it touches.

A key belongs to a slice by its hash; a slice is a folder, and inside it rows are bucketed by key, so that joins by key
move the other side only. An update writes the new content of the touched slices beside the old and then adds one file to the
log, which names the folder that holds each slice. That file is the commit: before it nothing has changed, after it
everything has, and readers of an earlier commit keep what they saw. There is one writer at a time.

The log also tells which batch of which stream a commit came from, so a batch that is sent again changes nothing, and a
stream that starts anew goes on from the present content. ``retain`` drops what no kept commit refers to.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

LOG_SCHEMA = "commit bigint, stream string, batch bigint, slice int, folder string, slices int, buckets int"
SLICE = "_slice"


class KeyedTable:
    """Rows of ``schema`` below ``root``, replaced by ``key``.

    ``slices`` bounds what an update of one key rewrites, ``buckets`` is the number of tasks that read a set of slices; both
    are fixed when the table is made. Sizes to aim at: a slice of some GB, ``buckets`` no fewer than tasks wanted per update.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | StructType, key: str, *, slices: int = 64, buckets: int = 8):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.schema = spark.createDataFrame([], schema).schema
        self.slices, self.buckets = slices, buckets
        made = self.log().select("slices", "buckets").first()
        if made is not None and tuple(made) != (slices, buckets):
            raise ValueError(f"the table has {made[0]} slices and {made[1]} buckets")

    # ---- the log ----

    def _path(self, path: str):
        """A path and its file system, as Spark sees them."""
        jvm = self.spark.sparkContext._jvm
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def log(self) -> DataFrame:
        """One row per commit and slice it replaced: the folder that holds the slice, null if it has no rows any more."""
        path, fs = self._path(f"{self.root}/log")
        if not fs.exists(path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.root}/log")

    def last_commit(self) -> int:
        return self.log().agg(F.max("commit")).first()[0] or 0

    def applied(self, stream: str, batch: int) -> bool:
        """Whether this batch of a stream, or a later one, is part of the table."""
        return not self.log().where((F.col("stream") == stream) & (F.col("batch") >= batch)).isEmpty()

    def folders(self, commit: int | None = None) -> dict[int, str]:
        """Folder of each slice with rows, at a commit or now; at most ``slices`` entries."""
        log = self.log()
        if commit is not None:
            if commit < self._horizon():
                raise ValueError(f"commit {commit} is no longer kept")
            log = log.where(F.col("commit") <= commit)
        held = log.where("slice IS NOT NULL").groupBy("slice").agg(F.max_by("folder", "commit").alias("folder"))
        return {r["slice"]: r["folder"] for r in held.where("folder IS NOT NULL").collect()}

    # ---- reading ----

    def slice_of(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.slices)).cast("int")

    def read(self, slices: Iterable[int] | None = None, commit: int | None = None) -> DataFrame:
        """Rows of some or all slices, as a scan that is bucketed by key."""
        asked = None if slices is None else set(slices)
        there = {s: f for s, f in self.folders(commit).items() if asked is None or s in asked}
        if not there:
            return self.spark.createDataFrame([], self.schema)
        # The session's catalog is where Spark looks for buckets; the name stands for exactly these folders.
        name = f"keyed_{hashlib.md5(repr((self.root, sorted(there.items()))).encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}, {SLICE} int) USING parquet PARTITIONED BY ({SLICE}) "
                           f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self._quoted(f'{self.root}/data')}'")
            parts = " ".join(f"PARTITION ({SLICE}={s}) LOCATION '{self._quoted(self._folder(f, s))}'" for s, f in sorted(there.items()))
            self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name).drop(SLICE)

    def _folder(self, folder: str, number: int) -> str:
        return f"{self.root}/data/{folder}/{SLICE}={number}"

    @staticmethod
    def _quoted(text: str) -> str:
        return re.sub(r"(['\\])", r"\\\1", text)

    # ---- writing ----

    def touched(self, *keys: DataFrame) -> list[int]:
        """Slices of the keys in the first column of some tables."""
        found = set()
        for table in keys:
            found |= {r[0] for r in table.select(self.slice_of(F.col(f"`{table.columns[0]}`"))).distinct().collect()}
        return sorted(found)

    def update(self, stale: DataFrame, fresh: DataFrame, *, stream: str = "", batch: int | None = None) -> list[int]:
        """Rows whose key is in ``stale`` go, ``fresh`` rows come; a key that is in both is replaced. Returns the slices written.

        Both are read more than once; write them out first if they are dear.
        """
        if stream and batch is not None and self.applied(stream, batch):
            return []
        stale = stale.select(F.col(f"`{stale.columns[0]}`").alias(self.key))
        slices = self.touched(stale, fresh.select(self.key))
        folder, written = uuid.uuid4().hex, []
        if slices:
            # Placed like the buckets, the stale keys meet the table where it is.
            placed = lambda df: df.repartition(self.buckets, self.key)
            kept = self.read(slices).join(placed(stale.distinct()), self.key, "left_anti").select(*self.schema.names)
            rows = kept.unionByName(placed(fresh.select(*self.schema.names)))
            scratch = f"keyed_write_{folder}"
            (rows.withColumn(SLICE, self.slice_of(self.key)).write.format("parquet").partitionBy(SLICE).bucketBy(self.buckets, self.key)
             .option("path", f"{self.root}/data/{folder}").saveAsTable(scratch))
            written = [r[0] for r in self.spark.table(scratch).select(SLICE).distinct().collect()]
            self.spark.sql(f"DROP TABLE {scratch}")  # from the catalog; the files stay
        commit = self.last_commit() + 1
        if slices or (stream and batch is not None):
            entries = [(commit, stream, batch, s, folder if s in written else None, self.slices, self.buckets) for s in slices or [None]]
            self._write_log(self.spark.createDataFrame(entries, LOG_SCHEMA))
        return slices

    def _write_log(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.parquet(f"{self.root}/log/{uuid.uuid4().hex}")

    # ---- retention ----

    def retain(self, commits: int = 10) -> int:
        """Drop slices that none of the last ``commits`` commits can see, and their log entries; returns how many."""
        horizon = self.last_commit() - commits + 1
        if horizon <= self._horizon():
            return 0
        later = F.lead("commit").over(Window.partitionBy("slice").orderBy("commit"))
        newest = F.max("batch").over(Window.partitionBy("stream"))
        entries = (self.log().distinct().withColumn("newest", (F.col("batch") == newest) & (F.col("stream") != ""))
                   .withColumn("gone", F.when(F.col("slice").isNull(), F.lit(True)).otherwise(F.coalesce(later <= horizon, F.lit(False)))))
        dead = [(r["slice"], r["folder"]) for r in entries.where("gone AND folder IS NOT NULL").select("slice", "folder").collect()]
        # An entry that tells the last batch of a stream stays, without its slice if that has gone.
        names = self.log().columns
        bare = entries.where("gone AND newest").withColumn("slice", F.lit(None).cast("int")).withColumn("folder", F.lit(None).cast("string")).distinct()
        mark = self.spark.createDataFrame([(horizon, "", None, None, None, self.slices, self.buckets)], LOG_SCHEMA)
        path, fs = self._path(f"{self.root}/log")
        before = [status.getPath() for status in fs.listStatus(path)]
        self._write_log(entries.where("NOT gone").select(*names).unionByName(bare.select(*names)).unionByName(mark))
        for old in before:
            fs.delete(old, True)
        for number, folder in dead:
            path, fs = self._path(self._folder(folder, number))
            fs.delete(path, True)
        return len(dead)

    def _horizon(self) -> int:
        """The first commit that can still be read."""
        return self.log().where("slice IS NULL AND stream = '' AND batch IS NULL").agg(F.max("commit")).first()[0] or 1

"""Keyed state of a stream, stored in levels.

Every batch adds one run of rows, the last write of each of its keys. When a level has ``fanout`` runs they are
folded into one run of the next level, while the stream goes on: a row is written again once for each level, and a
reader meets fewer than ``fanout`` runs a level, however many batches there were. A list for each batch names
the runs that make up the state after it; a batch that is run again starts from the list before it and writes
its own folders anew, and a reader never sees half a batch.

Runs are hashed into buckets and sorted by the key, with a Bloom filter on it: the read of one key opens one bucket
of each run and skips its row groups.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.operators.daytable import read_stored
from dispatchlake.operators.keyed import latest_per_key

LIST = "level int, run string"


@dataclass(frozen=True)
class LevelState:
    """``keys`` name a row, the first of them also its bucket; ``order`` tells which write of a key is the last."""

    root: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    fanout: int = 8
    buckets: int = 16

    def runs(self, spark: SparkSession, before: int | None = None) -> list[tuple[int, str]]:
        """Level and folder of the live runs, of the state after all batches or before a given one."""
        lists = read_stored(spark, T.StructType.fromDDL(f"{LIST}, batch long"), f"{self.root}/lists")
        if before is not None:
            lists = lists.filter(F.col("batch") < before)
        last = lists.agg(F.max("batch")).first()[0]
        if last is None:
            return []
        rows = lists.filter((F.col("batch") == last) & F.col("run").isNotNull()).collect()  # a few for each level
        return sorted((r["level"], r["run"]) for r in rows)

    def add(self, rows: DataFrame, batch: int) -> None:
        """The state after a batch: its last writes as a new run, full levels folded."""
        spark = rows.sparkSession
        live = self.runs(spark, batch)
        live.append((0, self._write(latest_per_key(rows, list(self.keys), list(self.order)), batch, 0)))
        level = 0
        while len(full := [run for at, run in live if at == level]) >= self.fanout:
            folded = latest_per_key(self._read(spark, full, rows.schema), list(self.keys), list(self.order))
            live = [(at, run) for at, run in live if at != level]
            level += 1
            live.append((level, self._write(folded, batch, level)))
        listed = spark.createDataFrame(live, LIST).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.root}/lists/batch={batch}")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The last write of every key."""
        stored = self._read(spark, [run for _, run in self.runs(spark)], schema)
        return latest_per_key(stored, list(self.keys), list(self.order))

    def lookup(self, spark: SparkSession, schema: T.StructType, value: object) -> DataFrame:
        """The last writes under one value of the first key; opens one bucket of each run."""
        bucket = spark.range(1).select(self._bucket(F.lit(value).cast(schema[self.keys[0]].dataType))).first()[0]
        runs = [run for _, run in self.runs(spark)]
        stored = self._read(spark, runs, schema, bucket).filter(F.col(self.keys[0]) == F.lit(value))
        return latest_per_key(stored, list(self.keys), list(self.order))

    def vacuum(self, spark: SparkSession, keep: int = 1) -> list[str]:
        """Remove runs that none of the last ``keep`` lists names, and older lists. Returns the folders removed.

        Readers that opened an older list lose their files, so ``keep`` has to cover the longest read.
        """
        lists = read_stored(spark, T.StructType.fromDDL(f"{LIST}, batch long"), f"{self.root}/lists")
        batches = sorted((r["batch"] for r in lists.select("batch").distinct().collect()), reverse=True)
        old = batches[keep:]
        named = {(r["batch"] in old, r["run"]) for r in lists.select("batch", "run").distinct().collect()}
        gone = sorted({run for stale, run in named if stale} - {run for stale, run in named if not stale})
        folders = [f"{self.root}/runs/{run}" for run in gone] + [f"{self.root}/lists/batch={b}" for b in old]
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return folders

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, batch: int, level: int) -> str:
        run = f"batch-{batch}-level-{level}"
        placed = rows.withColumn("bucket", self._bucket(F.col(self.keys[0])))
        writer = placed.repartition("bucket").sortWithinPartitions("bucket", *self.keys).write.mode("overwrite")
        writer = writer.option(f"parquet.bloom.filter.enabled#{self.keys[0]}", "true")
        writer.partitionBy("bucket").parquet(f"{self.root}/runs/{run}")
        return run

    def _read(self, spark: SparkSession, runs: list[str], schema: T.StructType, bucket: int | None = None) -> DataFrame:
        part = "" if bucket is None else f"/bucket={bucket}"
        stored = [read_stored(spark, schema, f"{self.root}/runs/{run}{part}").select(*schema.names) for run in runs]
        return reduce(DataFrame.unionByName, stored, spark.createDataFrame([], schema))

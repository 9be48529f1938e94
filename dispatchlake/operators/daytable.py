"""Keyed tables stored by event day, where a merge rewrites only the days it touches.

Files are at ``data/day=<day>/version=<version>``; rows without a day are under ``none``. Next to them,
``live/<version>`` lists for every day which version of it is read. A merge adds new folders and a new
list, and never changes a folder someone may be reading; the caller makes the new list current.

Day lists come to the driver: one entry per calendar day whatever the data size. Only the folders they
name are listed and read. Folders that no list in use names can be removed at any time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.operators.keyed import align, latest_per_key, merge_staged
from dispatchlake.operators.sinks import write_days
from dispatchlake.session import settle

DAY, VERSION = "day", "version"
FOLDERS = [T.StructField(DAY, T.StringType()), T.StructField(VERSION, T.StringType())]


SMALL_STAGED = 10 << 20  # bytes of a stored source, which costs little to read again
BY_DAY, BY_MONTH = "yyyy-MM-dd", "yyyy-MM"


def day_key(period: str = BY_DAY) -> Column:
    """The folder a row belongs to."""
    return F.coalesce(F.date_format("event_date", period), F.lit("none"))


def read_stored(spark: SparkSession, schema: T.StructType, *paths: str, base: str | None = None) -> DataFrame:
    """Stored files under their declared schema, or an empty frame where nothing was written yet."""
    reader = spark.read.schema(schema)
    try:
        if paths:
            return (reader.option("basePath", base) if base else reader).parquet(*paths)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class DayTable:
    """A table with an ``event_date``. ``period`` may widen its folders, for tables with small days."""

    root: str
    schema: T.StructType
    keys: list[str]
    newest_by: list[str]
    period: str = BY_DAY

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def live(self, spark: SparkSession, version: str | None) -> dict[str, str]:
        """Day to version of the folders that make up a table version."""
        if version is None:
            return {}
        return {r[DAY]: r[VERSION] for r in spark.read.parquet(f"{self.root}/live/{version}").collect()}

    def _read_folders(self, spark: SparkSession, *paths: str) -> DataFrame:
        return read_stored(spark, T.StructType([*self.schema.fields, *FOLDERS]), *paths, base=self.data)

    def _of_version(self, spark: SparkSession, version: str) -> DataFrame:
        return self._read_folders(spark, f"{self.data}/{DAY}=*/{VERSION}={version}")

    def read(self, spark: SparkSession, version: str | None, days: list[str] | None = None) -> DataFrame:
        """Rows of a table version with their day, of all days or of the given ones. Lists only their folders."""
        live = self.live(spark, version)
        chosen = sorted(live) if days is None else sorted(live.keys() & set(days))
        folders = [f"{self.data}/{DAY}={d}/{VERSION}={live[d]}" for d in chosen]
        return self._read_folders(spark, *folders).drop(VERSION)

    def merge(self, spark: SparkSession, source: DataFrame, current: str | None, version: str) -> list[str]:
        """Merge ``source`` into the ``current`` version, stored as ``version``. Returns the days touched.

        Days are touched by rows that arrive and by stored rows of the same keys, which may lie on other
        days. Finding the latter reads the key columns only.
        """
        if not self._of_version(spark, version).isEmpty():
            raise ValueError(f"version {version} of {self.root} was used before")
        newest = latest_per_key(align(source, self.schema.names), self.keys, self.newest_by)
        staged = settle(newest.withColumn(DAY, day_key(self.period)), "staged")
        held = self.read(spark, current).select(*self.keys, DAY)
        found = held.join(staged.select(*self.keys), self.keys, "left_semi")
        touched = [r[DAY] for r in staged.select(DAY).union(found.select(DAY)).distinct().collect()]

        merged = merge_staged(self.read(spark, current, touched), staged, self.keys, small=SMALL_STAGED)
        write_days(merged.withColumn(VERSION, F.lit(version)), self.data, DAY, VERSION)
        written = self._of_version(spark, version).select(DAY).distinct()
        kept = {d: v for d, v in self.live(spark, current).items() if d not in touched}
        live = {**kept, **{r[DAY]: version for r in written.collect()}}
        lists = spark.createDataFrame(list(live.items()), T.StructType(FOLDERS)).coalesce(1)
        lists.write.mode("overwrite").parquet(f"{self.root}/live/{version}")
        return touched

    def create_view(self, spark: SparkSession, name: str, version: str) -> None:
        """Point the view ``name`` at a table version, so that SQL readers move over in one step."""
        folders = [
            f"(`{VERSION}` = '{v}' AND string(`{DAY}`) IN ({', '.join(repr(d) for d in days)}))"
            for v, days in _by_version(self.live(spark, version)).items()
        ]
        columns = ", ".join(f"`{c}`" for c in self.schema.names)
        rows = f"SELECT {columns} FROM parquet.`{self.data}` WHERE {' OR '.join(folders)}"
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {rows if folders else f'SELECT {none} WHERE false'}")


def _by_version(live: dict[str, str]) -> dict[str, list[str]]:
    versions: dict[str, list[str]] = {}
    for day, version in sorted(live.items()):
        versions.setdefault(version, []).append(day)
    return versions

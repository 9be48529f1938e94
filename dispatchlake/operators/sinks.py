"""Writes. A repeated run gives the same table: days are replaced, never added twice."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.schemas import ADDRESS_PREFIX, MERCHANT_CSV

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder name of a null


def write_days(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions present in ``df``: by ``event_date`` unless told otherwise.

    Rebalancing groups a day's rows into few files, and splits a day that is much larger than the
    advisory size over several tasks, so neither small files nor a hot day pile up.
    """
    by = by or ("event_date",)
    (
        df.hint("rebalance", *by)
        .write.partitionBy(*by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def replace_days(df: DataFrame, path: str, owner: str, days: list[date], *by: str) -> None:
    """Replace all that the ``days`` of ``owner``, one of the columns in ``by``, ever brought to a table.

    Like :func:`write_days`, but partitions that the days filled before and no longer fill end empty. They are cleared
    after the write, so a reader finds old or new rows and never less. Partitions are counted in calendar days, so
    their list may come to the driver; only a repeated day computes ``df`` a second time, for that list.
    """

    def folders(rows: DataFrame) -> set[str]:
        names = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in by]
        return {r[0] for r in rows.select(F.concat_ws("/", *names)).distinct().collect()}

    spark = df.sparkSession
    keys = T.StructType([df.schema[c] for c in by])
    try:
        stored = spark.read.schema(keys).parquet(path).filter(F.col(owner).isin(days))
    except AnalysisException:  # the first write
        stored = None
    before = folders(stored) if stored is not None else set()
    write_days(df, path, *by)
    if before:
        nothing = spark.createDataFrame([], T.StructType([f for f in df.schema if f.name not in by]))
        for folder in sorted(before - folders(df)):
            write_all(nothing, f"{path}/{folder}")


def write_all(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def broker_sink_options(bootstrap_servers: str) -> dict[str, str]:
    """Delivery guarantees of published records: acknowledged by all replicas, three retries."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "kafka.acks": "all", "kafka.retries": "3"}


def publish_records(records: DataFrame, bootstrap_servers: str) -> None:
    """Records with topic, key and value to a broker (the connector package has to be on the class path)."""
    sink = records.select("topic", "key", "value").write.format("kafka")
    sink.options(**broker_sink_options(bootstrap_servers)).save()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_merchants(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(MERCHANT_CSV).csv(path)


def clean_merchants(merchants: DataFrame) -> DataFrame:
    """Merchant rows whose address lost its label."""
    return merchants.withColumn("Address", F.replace("Address", F.lit(ADDRESS_PREFIX), F.lit("")))


def append_to(df: DataFrame, path: str) -> None:
    """Add rows to a stored table; what is there stays as it is. A repeated load is stored twice."""
    df.write.mode("append").parquet(path)


def write_buckets(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Replace a catalog table, hashed and sorted by its keys: joins and merges on them do not shuffle it.

    One file for each bucket, with a Bloom filter on the keys. Take no fewer buckets than shuffle partitions, or Spark
    shuffles the table to their number.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.saveAsTable(table)

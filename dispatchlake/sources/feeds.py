"""Where feed records and lake tables are read from."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.functions.keys import DEFAULT_TOPIC_PATTERN, topic_name
from dispatchlake.operators import messages
from dispatchlake.operators.silver import reject_reason
from dispatchlake.schemas import BRONZE_ORDERS, FEEDS, LANDED_RECORD, READ_RECORD


@dataclass
class JobConfig:
    """Runtime settings, each from an environment variable with a default."""

    bootstrap_servers: str | None = None
    topics: list[str] = field(default_factory=lambda: [topic_name(f) for f in FEEDS])
    starting_offsets: str = "earliest"
    max_records_per_trigger: int | None = None
    lake: str = "lake"
    landing: str | None = None
    topic_pattern: str = DEFAULT_TOPIC_PATTERN

    @classmethod
    def from_env(cls, env=os.environ) -> JobConfig:
        pattern = env.get("TOPIC_PATTERN", DEFAULT_TOPIC_PATTERN)
        topics = env.get("KAFKA_TOPICS")
        limit = env.get("MAX_RECORDS_PER_TRIGGER")
        return cls(
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS"),
            topics=[t.strip() for t in topics.split(",")] if topics else [topic_name(f, pattern) for f in FEEDS],
            starting_offsets=env.get("STARTING_OFFSETS", "earliest"),
            max_records_per_trigger=int(limit) if limit else None,
            lake=env.get("LAKE_ROOT", "lake"),
            landing=env.get("LANDING_DIR"),
            topic_pattern=pattern,
        )


def broker_options(config: JobConfig) -> dict[str, str]:
    """Options of ``readStream.format("kafka")``; offsets live in the query's checkpoint, not in the broker."""
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers or "",
        "subscribe": ",".join(config.topics),
        "startingOffsets": config.starting_offsets,
    }
    if config.max_records_per_trigger:
        options["maxOffsetsPerTrigger"] = str(config.max_records_per_trigger)
    return options


def read_broker(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Records of all topics from a broker (the connector package has to be on the class path)."""
    raw = spark.readStream.format("kafka").options(**broker_options(config)).load()
    return raw.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "offset",
        "timestamp",
        "partition",
    )


def read_landing(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Records from files that appear in a folder: the same columns, for replays and tests."""
    return spark.readStream.schema(READ_RECORD).options(**options).parquet(path)


def read_records(spark: SparkSession, config: JobConfig) -> DataFrame:
    if config.bootstrap_servers:
        return read_broker(spark, config)
    if config.landing:
        return read_landing(spark, config.landing)
    raise ValueError("set KAFKA_BOOTSTRAP_SERVERS or LANDING_DIR")


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan: with a declared schema (absent columns are null) or with the files' own."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_bronze_orders(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, BRONZE_ORDERS)


def read_lake_messages(spark: SparkSession, path: str, topic: str, ingest_days: list[date] | None = None) -> DataFrame:
    """Records of a topic out of the raw landing lake, their values decoded as orders into ``message``.

    Topic and days are partition columns, so only the folders asked for are listed and read.
    """
    raw = spark.read.schema(LANDED_RECORD).parquet(path).filter(F.col("topic") == topic)
    if ingest_days is not None:
        raw = raw.filter(F.col("ingest_date").isin(ingest_days))
    return messages.decode(raw, BRONZE_ORDERS)


def lake_orders(decoded: DataFrame) -> DataFrame:
    """Readable orders with their ingest day."""
    parsed = decoded.filter(~messages.unreadable())
    return parsed.select(*[F.col(f"message.{c}").alias(c) for c in BRONZE_ORDERS.names], "ingest_date")


def lake_rejects(decoded: DataFrame) -> DataFrame:
    """What silver leaves out: the records as they landed, with the reason."""
    reason = F.when(messages.unreadable(), "malformed json").otherwise(reject_reason("message."))
    return decoded.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("message")


def read_table(
    spark: SparkSession, name: str, source: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """A catalog table, or a table of an external warehouse when its connector name is given."""
    if source is None:
        return spark.table(name)
    return spark.read.format(source).options(**(options or {})).option("dbtable", name).load()

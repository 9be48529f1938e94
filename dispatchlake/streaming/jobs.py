"""Stream jobs: landing, keyed state, live daily counts.

Each sink is one query with its own checkpoint, so a restart goes on where the last committed batch
ended. ``foreachBatch`` writes go to a folder named after the batch, or replace whole partitions:
a batch that runs again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dispatchlake.functions.keys import DEFAULT_TOPIC_PATTERN
from dispatchlake.functions.parsing import parse_iso_time
from dispatchlake.operators import keyed, messages, sinks
from dispatchlake.operators.daytable import read_stored
from dispatchlake.schemas import STATE_SCHEMAS
from dispatchlake.streaming.state import LevelState

STORED_IDS = "topic string, message_id string, day string, batch_id long"
DRAIN = {"availableNow": True}
WRITE_ORDER = ("timestamp", "partition", "offset")
KEYS = {"orders": ["order_id", "event_timestamp"], "couriers": ["courier_id", "event_timestamp"]}


def land_bronze(
    records: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_records_per_file: int = 1_000_000,
    clock: Column | None = None,
) -> StreamingQuery:
    """Raw records to Parquet by topic, day and hour of landing.

    The file sink names its files itself and commits them with the batch: no overwritten file, no
    repeated record after a restart. The folder follows the time of the batch, not the record's own: a
    record that is late never lands in a day that a daily run has finished. ``clock`` replaces that time
    when a backlog is replayed into the days it came in.
    """
    landed_at = F.current_timestamp() if clock is None else clock
    landed = records.withColumns({"ingest_date": F.to_date(landed_at), "ingest_hour": F.hour(landed_at)})
    return (
        landed.writeStream.format("parquet")
        .partitionBy("topic", "ingest_date", "ingest_hour")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )


def land_messages(
    records: DataFrame, good_path: str, dead_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Readable messages and dead letters to two tables; a bad record never stops the stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = messages.decode(batch).persist()
        try:
            good, dead = messages.split_decoded(parsed)
            _write_batch(good, good_path, batch_id)
            _write_batch(dead, dead_path, batch_id)
        finally:
            parsed.unpersist()

    return _each_batch(records, write, checkpoint, trigger)


def land_once(
    records: DataFrame, path: str, dead_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Readable messages, each stored once however often it is delivered; dead letters apart.

    A message is known by topic and id (without an id by its text) and stored under the day of its event. A replay names the
    same day, so a batch is compared with the stored ids of its own days only, of which two columns are read:
    its cost does not grow with the history, and a late message is never dropped. A batch that is
    run again does not see what it wrote before and replaces it. Root and checkpoint belong together.
    """
    key = ["day", "topic", "message_id"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = messages.decode(batch).persist()
        try:
            good, dead = messages.split_decoded(parsed)
            event_time = parse_iso_time(F.coalesce("message.event_timestamp", "message.feedback_timestamp"))
            named = good.withColumns(
                {
                    "day": F.coalesce(F.date_format(event_time, "yyyy-MM-dd"), F.lit("none")),
                    "topic": F.coalesce("topic", F.lit("")),
                    "message_id": F.coalesce("message.event_id", "message.review_id", F.sha2("value", 256)),
                }
            )
            once = named.dropDuplicates(key)
            days = sorted(r["day"] for r in named.select("day").distinct().collect())  # calendar days
            stored = read_stored(spark, T.StructType.fromDDL(STORED_IDS), f"{path}/day={{{','.join(days)}}}" if days else path, base=path)
            seen = stored.filter(F.col("batch_id") != batch_id).select(*key)
            fresh = once.join(seen, key, "left_anti").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            sinks.write_days(fresh, path, "day", "batch_id")
            _write_batch(dead, dead_path, batch_id)
        finally:
            parsed.unpersist()

    return _each_batch(records, write, checkpoint, trigger)


def upsert_state(
    records: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    topic_pattern: str = DEFAULT_TOPIC_PATTERN,
) -> StreamingQuery:
    """Order and courier messages into the keyed tables below ``root``; what cannot be stored to dead letters.

    The state is stored in levels (:class:`dispatchlake.streaming.state.LevelState`): a batch costs what it brings,
    and its rows are folded with earlier ones as levels fill. Writes are ordered by landing time, partition and
    offset, as offsets of different partitions do not compare. Records of other topics go to
    ``unhandled_dead_letters``, so nothing vanishes. The batch is read from its source once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            split(batch, batch_id)
        finally:
            batch.unpersist()

    def split(batch: DataFrame, batch_id: int) -> None:
        other = batch.filter(messages.handler(F.col("topic"), topic_pattern) == "unhandled")
        _write_batch(other.withColumn("reason", F.lit("no table takes the topic")), f"{root}/unhandled_dead_letters", batch_id)
        for feed, contract, shape in (
            ("orders", messages.ORDER_TEXT, messages.shape_orders),
            ("couriers", messages.COURIER_TEXT, messages.shape_couriers),
        ):
            mine = batch.filter(messages.handler(F.col("topic"), topic_pattern) == feed)
            shaped = shape(messages.decode(mine, contract)).persist()
            try:
                state_of(root, feed).add(messages.storable(shaped, WRITE_ORDER), batch_id)
                _write_batch(messages.dead_letters(shaped), f"{root}/{feed}_dead_letters", batch_id)
            finally:
                shaped.unpersist()

    return _each_batch(records, write, checkpoint, trigger)


def state_of(root: str, feed: str) -> LevelState:
    return LevelState(f"{root}/{feed}", tuple(KEYS[feed]), WRITE_ORDER)


def read_state(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The keyed table of a feed: the last write of every key."""
    return state_of(root, feed).read(spark, STATE_SCHEMAS[feed])


def look_up_state(spark: SparkSession, root: str, feed: str, value: str) -> DataFrame:
    """The rows of one key of a feed's table, from the buckets that can hold it."""
    return state_of(root, feed).lookup(spark, STATE_SCHEMAS[feed], value)


def compact_state(spark: SparkSession, root: str, feed: str, compacted: str) -> None:
    """The state of a stopped query as one run in a new root; point readers and the query there."""
    state_of(compacted, feed).add(read_state(spark, root, feed), -1)


def daily_counts(
    orders: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Live order, delivered and cancelled counts per event day.

    The state holds one row per day. Each batch stores the days it changed; :func:`read_daily_counts`
    takes the newest row of each.
    """
    status = F.upper("order_status")
    counts = orders.groupBy("event_date").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(status == "DELIVERED").alias("delivered_orders"),
        F.count_if(status == "CANCELLED").alias("cancelled_orders"),
    )
    return _each_batch(
        counts, lambda batch, batch_id: _write_batch(batch, path, batch_id), checkpoint, trigger, mode="update"
    )


def read_daily_counts(spark: SparkSession, path: str) -> DataFrame:
    return keyed.latest_per_key(spark.read.parquet(path), ["event_date"], ["batch_id"]).drop("batch_id")


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None,
    mode: str = "append",
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )

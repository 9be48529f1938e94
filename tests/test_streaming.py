"""Streams against their batch answers, over several batches and across restarts."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import bronze

from dispatchlake.operators import gold, keyed, messages, silver, sinks
from dispatchlake.schemas import BRONZE_ORDERS, COURIER_MESSAGE, FEED_RECORD
from dispatchlake.sources import driver_tables as given
from dispatchlake.sources import feeds
from dispatchlake.streaming import jobs
from dispatchlake.streaming.state import LevelState


def rows_of(df):
    return sorted(map(str, df.collect()))


def drain(start, *args, **kwargs):
    query = start(*args, **kwargs)
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def records(spark, sf_dir):
    return given.feed_records(given.table(spark, sf_dir, "events")).cache()


@pytest.fixture()
def landing(spark, records, folder):
    """All records in six files, so that one file per trigger makes six batches."""
    records.repartition(6).write.parquet(folder("landing"))
    return folder("landing")


def stream(spark, path):
    return feeds.read_landing(spark, path, maxFilesPerTrigger=1)


def test_landing_survives_restarts_without_repeats(spark, records, landing, folder):
    for _ in range(2):
        query = drain(jobs.land_bronze, stream(spark, landing), folder("lake"), folder("mark"))
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    landed = spark.read.parquet(folder("lake"))
    assert rows_of(landed.select(*records.columns)) == rows_of(records)
    assert {"topic", "ingest_date", "ingest_hour"} <= set(landed.columns)
    records.limit(3).write.mode("append").parquet(landing)
    drain(jobs.land_bronze, stream(spark, landing), folder("lake"), folder("mark"))
    assert spark.read.parquet(folder("lake")).count() == records.count() + 3


def test_dead_letters_do_not_stop_the_stream(spark, records, landing, folder):
    drain(jobs.land_messages, stream(spark, landing), folder("good"), folder("dead"), folder("mark"))
    good, dead = messages.split_dead_letters(records)
    assert rows_of(spark.read.parquet(folder("good")).select("topic", "offset")) == rows_of(good.select("topic", "offset"))
    assert rows_of(spark.read.parquet(folder("dead")).select("offset", "reason")) == rows_of(dead.select("offset", "reason"))


def test_state_equals_batch_upsert(spark, records, folder, sf_dir):
    couriers = given.courier_records(given.table(spark, sf_dir, "events"))
    again = couriers.withColumn("offset", F.col("offset") + 10**9).withColumn(
        "value", F.replace("value", F.lit("Van"), F.lit("Bicycle"))
    )
    both = couriers.unionByName(again)
    both.repartition(5).write.parquet(folder("landing"))
    drain(jobs.upsert_state, stream(spark, folder("landing")), folder("state"), folder("mark"))
    shaped = messages.shape_couriers(messages.decode(both, messages.COURIER_TEXT))
    expected = keyed.latest_per_key(messages.storable(shaped), jobs.KEYS["couriers"], ["offset"])
    state = jobs.read_state(spark, folder("state"), "couriers")
    assert rows_of(state.select(*expected.columns)) == rows_of(expected)
    refused = spark.read.parquet(folder("state") + "/couriers_dead_letters")
    assert refused.count() == messages.rejected(shaped).count() > 0
    one = keyed.key_timeline(state, "courier_id", "3", ["event_timestamp"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(courier_id,3)" in plan  # a key read prunes increments at the scan
    times = [r.event_timestamp for r in one.collect()]
    assert times == sorted(times, reverse=True) and len(times) == expected.filter("courier_id = '3'").count() > 1
    jobs.compact_state(spark, folder("state"), "couriers", folder("compact"))
    assert rows_of(jobs.read_state(spark, folder("compact"), "couriers").select(*expected.columns)) == rows_of(expected)


def test_a_repeated_batch_replaces_itself(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for _ in range(2):
        jobs._write_batch(df, folder("t"), 3)
    assert spark.read.parquet(folder("t")).count() == 1


def test_order_and_courier_state_from_one_stream(spark, folder):
    order = {
        "event_id": "e1", "event_timestamp": "2025-02-10T10:00:00Z", "order_id": "o1", "merchant_id": "m1",
        "customer_id": "u1", "service_type": "groceries", "order_status": "created", "items": [],
        "delivery_location": {"latitude": 1.0, "longitude": 2.0, "address": "x"}, "delivery_fee": "1",
        "total_amount": "2", "estimated_delivery_time": "2025-02-10T10:45:00Z", "payment_method": "card",
        "payment_status": "pending",
    }
    values = [
        ("shop.orders", json.dumps(order), 1),
        ("shop.orders", json.dumps({**order, "order_status": "delivered"}), 2),
        ("shop.orders", json.dumps({**order, "total_amount": None}), 3),
        ("shop.reviews", json.dumps({"review_id": "r"}), 4),
    ]
    rows = [(t, "k", v, o, None) for t, v, o in values]
    spark.createDataFrame(rows, FEED_RECORD).repartition(4).write.parquet(folder("landing"))
    drain(
        jobs.upsert_state, stream(spark, folder("landing")), folder("state"), folder("mark"), topic_pattern="shop.{feed}"
    )
    state = jobs.read_state(spark, folder("state"), "orders").collect()
    assert [(r.order_id, r.order_status, r.offset) for r in state] == [("o1", "delivered", 2)]
    assert jobs.read_state(spark, folder("state"), "couriers").count() == 0
    dead = spark.read.parquet(folder("state") + "/orders_dead_letters").collect()
    assert [(r.offset, r.reason) for r in dead] == [(3, "bad or missing total_amount")]


def test_replays_are_stored_once(spark, folder):
    def value(i, day):
        return json.dumps({"event_id": f"e{i}", "event_timestamp": f"2025-03-{day:02d}T10:00:00Z", "order_id": "o"})

    def deliver(*values):
        rows = [("orders-raw", "k", v, i, None) for i, v in enumerate(values)]
        spark.createDataFrame(rows, FEED_RECORD).coalesce(1).write.mode("append").parquet(folder("landing"))
        drain(jobs.land_once, stream(spark, folder("landing")), folder("once"), folder("dead"), folder("mark"))

    no_id = json.dumps({"event_timestamp": "no time"})
    deliver(value(1, 1), value(1, 1), value(2, 1), no_id)
    deliver(value(3, 2), value(2, 1), "{torn", no_id)
    deliver(value(4, 1), value(3, 2), value(1, 1))  # a late one, and replays over a restart
    stored = spark.read.parquet(folder("once"))
    got = sorted((str(r.day), str(r.message.event_id)) for r in stored.select("day", "message").collect())
    assert got == [("2025-03-01", "e1"), ("2025-03-01", "e2"), ("2025-03-01", "e4"), ("2025-03-02", "e3"), ("none", "None")]
    assert spark.read.parquet(folder("dead")).count() == 1


def test_levels_fold_while_batches_come(spark, folder):
    schema = "courier_id string, event_timestamp timestamp, v long, offset long, timestamp timestamp, partition int"
    state = LevelState(folder("levels"), ("courier_id", "event_timestamp"), jobs.WRITE_ORDER, fanout=3, buckets=4)
    clock = datetime(2025, 1, 1)
    last, rng = {}, random.Random(3)
    for batch in range(14):
        rows = []
        for i in range(12):
            key = f"c{rng.randrange(9)}"
            # a later landing wins, whatever its offset is
            rows.append((key, clock, batch * 100 + i, rng.randrange(50), clock + timedelta(minutes=batch * 20 + i), i % 3))
        if batch == 5:
            rows = []
        last.update({r[0]: r for r in rows})
        df = spark.createDataFrame(rows, schema)
        state.add(df, batch)
        if batch == 7:
            state.add(df, batch)  # run again after a failure
    live = state.runs(spark)
    assert len(live) <= 2 * 4 and max(at for at, _ in live) == 2
    assert sorted(map(tuple, state.read(spark, df.schema).collect())) == sorted(last.values())
    for key in ("c3", "c8", "none"):
        found = state.lookup(spark, df.schema, key)
        assert [tuple(r) for r in found.collect()] == ([last[key]] if key in last else [])
        assert len({f.split("bucket=")[1][0] for f in found.inputFiles()}) <= 1
    assert len(state.vacuum(spark)) > 14 and state.vacuum(spark) == []
    assert sorted(map(tuple, state.read(spark, df.schema).collect())) == sorted(last.values())
    assert state.runs(spark) == live


def test_unhandled_topics_are_kept(spark, folder):
    rows = [("elsewhere", "k", "{}", 1, None), ("couriers-raw", "k", "torn", 2, None)]
    spark.createDataFrame(rows, FEED_RECORD).write.parquet(folder("landing"))
    drain(jobs.upsert_state, stream(spark, folder("landing")), folder("state"), folder("mark"))
    kept = spark.read.parquet(folder("state") + "/unhandled_dead_letters").collect()
    assert [(r.topic, r.value, r.reason) for r in kept] == [("elsewhere", "{}", "no table takes the topic")]
    assert spark.read.parquet(folder("state") + "/couriers_dead_letters").first().value == "torn"


def test_live_counts_equal_batch(spark, folder, sf_dir):
    feed = given.bronze_orders(spark, sf_dir)
    feed.repartition(3).write.parquet(folder("landing"))
    source = spark.readStream.schema(BRONZE_ORDERS).option("maxFilesPerTrigger", 1).parquet(folder("landing"))
    drain(jobs.daily_counts, silver.silver_orders(source.drop("items")), folder("daily"), folder("mark"))
    expected = gold.fulfillment(silver.silver_orders(feed)).select(
        "event_date", "total_orders", "delivered_orders", "cancelled_orders"
    )
    got = jobs.read_daily_counts(spark, folder("daily")).select(*expected.columns)
    assert rows_of(got) == rows_of(expected)


def test_late_events_are_counted(spark, folder):
    for day in ("2025-02-10", "2025-02-12", "2025-02-10"):
        bronze(spark, {"event_timestamp": f"{day} 10:00:00"}).coalesce(1).write.mode("append").parquet(folder("landing"))
        source = spark.readStream.schema(BRONZE_ORDERS).parquet(folder("landing"))
        drain(jobs.daily_counts, silver.silver_orders(source.drop("items")), folder("daily"), folder("mark"))
    got = {str(r.event_date): r.total_orders for r in jobs.read_daily_counts(spark, folder("daily")).collect()}
    assert got == {"2025-02-10": 2, "2025-02-12": 1}


def test_broker_options():
    config = feeds.JobConfig.from_env(
        {"KAFKA_BOOTSTRAP_SERVERS": "b:9092", "KAFKA_TOPICS": "a, b", "MAX_RECORDS_PER_TRIGGER": "200"}
    )
    assert feeds.broker_options(config) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "200",
    }
    assert feeds.JobConfig.from_env({"TOPIC_PATTERN": "x.{feed}"}).topics[0] == "x.orders"
    with pytest.raises(ValueError):
        feeds.read_records(None, feeds.JobConfig())


def test_publishing_is_acknowledged_by_all():
    assert sinks.broker_sink_options("b:9092") == {
        "kafka.bootstrap.servers": "b:9092",
        "kafka.acks": "all",
        "kafka.retries": "3",
    }

"""The query catalogue: one entry per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.functions.keys import landing_path
from dispatchlake.functions.parsing import parse_iso_time, parse_time, to_double, to_float
from dispatchlake.operators import days, gold, inference, keyed, messages, quality, silver, sinks
from dispatchlake.operators.daytable import BY_MONTH, DayTable
from dispatchlake.schemas import (
    BRONZE_ORDERS,
    COURIER_MESSAGE,
    DELIVERY_STATUSES,
    FEEDS,
    ORDER_MESSAGE,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    RATING_RANGE,
    REVIEW_MESSAGE,
    SERVICE_TYPES,
    SILVER_ORDERS,
    VEHICLE_TYPES,
)
from dispatchlake.session import configure, scratch
from dispatchlake.sources import driver_tables as given
from dispatchlake.sources import feeds
from dispatchlake.streaming import jobs, typed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register ``build`` under its own name; results carry zone-less timestamps."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(configure(spark), sf_dir)
        zoned = [f.name for f in df.schema.fields if f.dataType == T.TimestampType()]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

    QUERIES[build.__name__] = run
    return build


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------
def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_orders(given.bronze_orders(spark, sf))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return silver.order_items(given.item_messages(spark, sf))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return given.table(spark, sf, "events")


def _couriers(spark: SparkSession, sf: str) -> DataFrame:
    return given.courier_events(_events(spark, sf))


def _order_history(spark: SparkSession, sf: str) -> DataFrame:
    """Two events per order: placed, then its final status at the promised time."""
    placed = F.struct("event_timestamp", F.lit("created").alias("order_status"))
    final = F.struct(F.col("estimated_delivery_time").alias("event_timestamp"), "order_status")
    return (
        _orders(spark, sf)
        .select("order_id", "merchant_id", F.explode(F.array(placed, final)).alias("event"))
        .select("order_id", "event.event_timestamp", "event.order_status", "merchant_id")
    )


# ---------------------------------------------------------------------------
# scans
# ---------------------------------------------------------------------------
@query
def bronze_scan(spark, sf):
    """Landed order feed read back under the declared schema; a column the files lack reads as null."""
    path = scratch(spark, "bronze")
    given.bronze_orders(spark, sf).write.parquet(path)
    bronze = feeds.read_bronze_orders(spark, path)
    return bronze.select(
        *[c for c in bronze.columns if c not in ("items", "delivery_location")],
        F.col("items").isNull().alias("no_items"),
        F.col("delivery_location.address").alias("address"),
    )


@query
def silver_scan(spark, sf):
    """Scan under the files' own schema, pruned to the columns in use."""
    return feeds.scan(spark, f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@query
def table_counts(spark, sf):
    tables = {n: given.table(spark, sf, n) for n in ("orders", "lineitem", "events", "supplier")}
    tables["silver_orders"] = _orders(spark, sf)
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()
    ]
    return keyed.append(*counts)


# ---------------------------------------------------------------------------
# days
# ---------------------------------------------------------------------------
def _spine(spark, sf):
    bounds = given.table(spark, sf, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    return days.date_spine(bounds)


@query
def date_spine(spark, sf):
    return _spine(spark, sf)


@query
def pending_days(spark, sf):
    """Days with orders but without a delivered one (delivered days stand for processed ones)."""
    orders = _orders(spark, sf)
    return days.pending_days(
        days.present_days(orders), days.present_days(orders.filter(F.col("order_status") == "delivered"))
    )


@query
def empty_day_guard(spark, sf):
    return days.empty_days(_spine(spark, sf), _orders(spark, sf))


# ---------------------------------------------------------------------------
# parsing
# ---------------------------------------------------------------------------
@query
def parse_timestamps(spark, sf):
    bronze = given.bronze_orders(spark, sf)
    iso = F.concat(F.replace("event_timestamp", F.lit(" "), F.lit("T")), F.lit("Z"))
    return bronze.select(
        "event_id",
        parse_time("event_timestamp").alias("event_time"),
        parse_time("estimated_delivery_time").alias("promised_time"),
        parse_iso_time(iso).alias("iso_time"),
        (F.col("event_timestamp").isNotNull() & parse_time("event_timestamp").isNull()).alias("bad_time"),
    )


@query
def cast_money(spark, sf):
    bronze = given.bronze_orders(spark, sf)
    amount = to_double("total_amount")
    return bronze.select(
        "event_id",
        amount.alias("amount"),
        to_float("delivery_fee").alias("fee"),
        (F.col("total_amount").isNotNull() & amount.isNull()).alias("bad_amount"),
    )


@query
def parse_json_props(spark, sf):
    """Decoded properties; every ``error`` event's text is torn and comes out null and flagged."""
    torn = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    contract = T.StructType([T.StructField("k", T.LongType())])
    parsed = messages.decode(_events(spark, sf).withColumn("value", torn), contract)
    return parsed.select(
        "event_id",
        F.when(~messages.unreadable(), F.col("message.k")).alias("k"),
        messages.unreadable().alias("corrupt"),
    )


@query
def infer_bronze_schema(spark, sf):
    return inference.json_shape(_events(spark, sf), "props")


@query
def infer_message_schema(spark, sf):
    """Merged shape of the courier topic with its nested location, torn records skipped."""
    return inference.plain_shape(given.courier_records(_events(spark, sf)))


@query
def decode_with_inferred_schema(spark, sf):
    """Courier messages decoded with the schema inferred from all of them."""
    records = given.courier_records(_events(spark, sf))
    ddl = inference.infer_schema(records)
    message = F.from_json("value", ddl)
    return (
        messages.split_dead_letters(records)[0]
        .withColumn("m", message)
        .select(
            "offset",
            F.col("m.courier_id").alias("courier_id"),
            F.col("m.battery_level").cast("double").alias("battery_level"),
            F.col("m.is_online").alias("is_online"),
            F.col("m.current_location.latitude").alias("latitude"),
        )
    )


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------
@query
def silver_valid_filter(spark, sf):
    return silver.valid_orders(given.bronze_orders(spark, sf)).select(
        "event_id", "order_id", "merchant_id", to_double("total_amount").alias("total_amount")
    )


@query
def silver_rejects(spark, sf):
    """Orders that silver leaves out, with the first rule they break."""
    rejected = given.bronze_orders(spark, sf).withColumn("reason", silver.reject_reason())
    return rejected.filter(F.col("reason").isNotNull()).select("event_id", "order_id", "merchant_id", "total_amount", "reason")


@query
def silver_orders(spark, sf):
    return _orders(spark, sf)


@query
def order_items(spark, sf):
    """Items of valid orders, through the whole bronze to silver path."""
    return silver.order_items(silver.silver_orders(given.bronze_orders_with_items(spark, sf)))


@query
def preview_items(spark, sf):
    return _items(spark, sf).orderBy("order_id", "item_id", "quantity", "total_price").limit(5)


@query
def line_total(spark, sf):
    return silver.line_totals(_items(spark, sf))


@query
def order_total_from_items(spark, sf):
    """The lists of an order's messages folded, then added up per order."""
    totals = silver.order_totals(given.item_messages(spark, sf)).groupBy("order_id").agg(F.sum("items_total").alias("t"))
    return totals.select("order_id", F.col("t").cast("double").alias("items_total"))


@query
def align_to_target(spark, sf):
    """Silver columns in the warehouse's order; its upper-case names come out in lower case."""
    return keyed.align(_orders(spark, sf), ["TOTAL_AMOUNT", "ORDER_ID", "EVENT_DATE", "ORDER_STATUS", "IS_DELAYED"])


@query
def order_point_lookup(spark, sf):
    key = keyed.point_lookup(given.table(spark, sf, "orders"), "o_orderkey", 42)
    return silver.silver_orders(given.bronze_orders(spark, sf, key)).select(
        "order_id", "merchant_id", "order_status", "total_amount", "event_date"
    )


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------
@query
def orders_items_left_join(spark, sf):
    orders = _orders(spark, sf).select("order_id", "order_status", "total_amount", "event_date")
    return gold.orders_with_items(orders, _items(spark, sf))


@query
def event_order_lookup(spark, sf):
    """Courier events with the merchant of the order they name."""
    events = _couriers(spark, sf).select("event_id", "order_id", "courier_id")
    return messages.with_order(events, _orders(spark, sf))


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------
@query
def gold_fulfillment(spark, sf):
    return gold.fulfillment(_orders(spark, sf))


@query
def gold_delivery_time(spark, sf):
    return gold.delivery_time(_orders(spark, sf))


@query
def gold_order_volume(spark, sf):
    return gold.order_volume(_orders(spark, sf))


@query
def gold_order_volume_joined(spark, sf):
    return gold.order_volume_joined(_orders(spark, sf))


@query
def gold_order_volume_fanout(spark, sf):
    return gold.order_volume_per_item(_orders(spark, sf), _items(spark, sf))


@query
def gold_eta_accuracy(spark, sf):
    return gold.eta_accuracy(_orders(spark, sf))


@query
def gold_daily_metrics(spark, sf):
    return gold.daily_metrics(_orders(spark, sf))


@query
def hourly_orders(spark, sf):
    return gold.hourly_orders(_orders(spark, sf))


@query
def hourly_distribution(spark, sf):
    return gold.hourly_distribution(_orders(spark, sf))


@query
def top_days(spark, sf):
    return gold.top_days(gold.order_volume(_orders(spark, sf)))


# ---------------------------------------------------------------------------
# keyed tables
# ---------------------------------------------------------------------------
@query
def courier_timeline(spark, sf):
    rows = _couriers(spark, sf).select(
        "courier_id", "event_timestamp", F.col("event_id").cast("bigint").alias("event_id"), "delivery_status"
    )
    return keyed.timeline(rows, "courier_id", ["event_timestamp", "event_id"])


@query
def courier_current_state(spark, sf):
    rows = _couriers(spark, sf).select(
        "courier_id", "event_timestamp", F.col("event_id").cast("bigint").alias("event_id"), "delivery_status", "is_online"
    )
    return keyed.latest_per_key(rows, ["courier_id"], ["event_timestamp", "event_id"])


@query
def order_current_state(spark, sf):
    return keyed.latest_per_key(_order_history(spark, sf), ["order_id"], ["event_timestamp", "order_status"])


@query
def order_timeline(spark, sf):
    return keyed.timeline(
        _order_history(spark, sf).filter(F.col("event_timestamp").isNotNull()),
        "order_id",
        ["event_timestamp", "order_status"],
    )


def _order_messages(spark, sf):
    return messages.decode(given.order_records(spark, sf), messages.ORDER_TEXT)


@query
def ops_orders_upsert(spark, sf):
    rows = messages.storable(messages.shape_orders(_order_messages(spark, sf)))
    return keyed.latest_per_key(rows, jobs.KEYS["orders"], ["offset"])


@query
def ops_orders_rejects(spark, sf):
    """Order messages that cannot be stored, with the first reason."""
    return messages.rejected(messages.shape_orders(_order_messages(spark, sf))).select("event_id", "offset", "reason")


@query
def ops_courier_upsert(spark, sf):
    decoded = messages.decode(given.courier_records(_events(spark, sf)), messages.COURIER_TEXT)
    rows = messages.storable(messages.shape_couriers(decoded))
    return keyed.latest_per_key(rows, jobs.KEYS["couriers"], ["offset"])


def _two_loads(spark, sf):
    orders = _orders(spark, sf).select(
        "order_id", "merchant_id", "customer_id", "order_status", "total_amount", "event_date"
    )
    undated = F.col("event_date").isNull()
    target = orders.filter(undated | (F.col("event_date") < F.lit("1999-01-01").cast("date")))
    source = orders.filter(undated | (F.col("event_date") >= F.lit("1997-01-01").cast("date"))).withColumns(
        {"total_amount": F.col("total_amount") + 100, "order_status": F.lit("delivered")}
    )
    return target, source


@query
def merge_orders(spark, sf):
    """Orders loaded before 1999, merged with a reload of 1997 and later that changes amount and status;
    orders without a day are in both."""
    return keyed.merge_upsert(*_two_loads(spark, sf))


@query
def merge_orders_stored(spark, sf):
    """The same two loads merged one after the other into a stored table (by month), of which the second
    rewrites the folders it touches."""
    first, second = _two_loads(spark, sf)
    table = DayTable(scratch(spark, "orders"), first.schema, ["order_id"], ["event_date", "total_amount"], BY_MONTH)
    table.merge(spark, first, None, "v1")
    table.merge(spark, second, "v1", "v2")
    return table.read(spark, "v2").drop("day")


@query
def merge_order_items(spark, sf):
    """Items of quantity 20 and more, merged with repriced items below 30 that still repeat keys."""
    items = _items(spark, sf)
    target = keyed.keep_one(items, ["order_id", "item_id"]).filter(F.col("quantity") >= 20)
    source = items.filter(F.col("quantity") < 30).withColumn("total_price", F.col("total_price") * 2)
    return keyed.merge_upsert(target, source)


@query
def append_union(spark, sf):
    """Two overlapping loads appended; the second has its columns in another order."""
    orders = _orders(spark, sf).select("order_id", "order_status", "total_amount", "event_date")
    old = orders.filter(F.col("event_date").isNull() | (F.col("event_date") < F.lit("1998-01-01").cast("date")))
    new = orders.filter(F.col("event_date") >= F.lit("1997-01-01").cast("date")).select(
        "event_date", "total_amount", "order_status", "order_id"
    )
    return keyed.append(old, new)


@query
def dedup_events(spark, sf):
    """All events delivered twice, one kept."""
    events = _events(spark, sf)
    return keyed.drop_replays(keyed.append(events, events), ["event_id"])


# ---------------------------------------------------------------------------
# messages
# ---------------------------------------------------------------------------
@query
def publish_envelope(spark, sf):
    payload = ["event_id", "order_id", "merchant_id", "customer_id"]
    return messages.envelope(given.feed_events(_events(spark, sf)), payload)


@query
def route_by_topic(spark, sf):
    return messages.route_counts(given.feed_records(_events(spark, sf)))


@query
def dead_letter_split(spark, sf):
    _, dead = messages.split_dead_letters(given.feed_records(_events(spark, sf)))
    return dead.select("topic", "key", "offset", "reason")


@query
def bronze_path(spark, sf):
    """Landing paths of a dotted topic name per feed, with the records that land in each."""
    topic = F.concat(F.lit("delivery."), F.replace("topic", F.lit("-"), F.lit(".")))
    return (
        given.feed_records(_events(spark, sf))
        .select(landing_path(topic, F.col("timestamp")).alias("path"))
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("records"))
    )


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
@query
def merchant_csv_clean(spark, sf):
    raw, clean = scratch(spark, "merchants-raw"), scratch(spark, "merchants")
    sinks.write_csv(given.merchant_rows(given.table(spark, sf, "supplier")), raw)
    sinks.write_csv(sinks.clean_merchants(sinks.read_merchants(spark, raw)), clean)
    return sinks.read_merchants(spark, clean)


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("event_month", F.date_format("event_date", "yyyy-MM"))


@query
def silver_write_roundtrip(spark, sf):
    """Silver orders written twice and read back: the same rows as once.

    Partitioned by month here, as the given tables hold only a few orders per day; the daily job
    partitions by day.
    """
    path, orders = scratch(spark, "silver-orders"), _orders(spark, sf)
    for _ in range(2):
        sinks.write_days(_by_month(orders), path, "event_month")
    return spark.read.parquet(path).select(*orders.columns)


@query
def items_write_roundtrip(spark, sf):
    """Silver items written twice, placed by the day of their order, and read back."""
    path = scratch(spark, "silver-items")
    orders = silver.silver_orders(given.bronze_orders_with_items(spark, sf))
    items = silver.order_items(orders, carry=("event_date",))
    for _ in range(2):
        sinks.write_days(_by_month(items), path, "event_month")
    return spark.read.parquet(path).select(*items.columns)


@query
def append_write_roundtrip(spark, sf):
    """Two loads appended to one stored table, neither of them changing what is there."""
    path = scratch(spark, "appended")
    orders = _orders(spark, sf).select("order_id", "order_status", "total_amount", "event_date")
    sinks.append_to(orders.filter(F.col("order_status") == "delivered"), path)
    sinks.append_to(orders.filter(F.col("order_status") != "delivered"), path)
    return spark.read.parquet(path)


@query
def gold_write_roundtrip(spark, sf):
    """Fulfillment written in full, then refreshed for the days from 1998 on: the same rows as once."""
    orders = _orders(spark, sf)
    first, second = scratch(spark, "gold"), scratch(spark, "gold")
    sinks.write_all(gold.fulfillment(orders), first)
    recent = orders.filter(F.col("event_date") >= F.lit("1998-01-01").cast("date"))
    sinks.write_all(keyed.merge_upsert(spark.read.parquet(first), gold.fulfillment(recent), ["event_date"]), second)
    return spark.read.parquet(second)


# ---------------------------------------------------------------------------
# streams: drained to the end, then read back
# ---------------------------------------------------------------------------
def _stage(*loads: DataFrame) -> str:
    path = scratch(loads[0].sparkSession, "landing")
    for load in loads:
        load.write.mode("append").parquet(path)
    return path


@query
def stream_source_json(spark, sf):
    landing = _stage(given.feed_records(_events(spark, sf)))
    good, dead, mark = (scratch(spark, n) for n in ("messages", "dead-letters", "checkpoint"))
    jobs.land_messages(feeds.read_landing(spark, landing), good, dead, mark).awaitTermination()
    return spark.read.parquet(good).select(
        "topic",
        "key",
        "offset",
        F.col("message.event_id").alias("event_id"),
        F.col("message.order_id").alias("order_id"),
        parse_iso_time(F.coalesce("message.event_timestamp", "message.feedback_timestamp")).alias("event_time"),
    )


@query
def stream_to_bronze(spark, sf):
    landing = _stage(given.feed_records(_events(spark, sf)))
    lake, mark = scratch(spark, "bronze"), scratch(spark, "checkpoint")
    jobs.land_bronze(feeds.read_landing(spark, landing), lake, mark, clock=F.col("timestamp")).awaitTermination()
    return spark.read.parquet(lake).select("topic", "ingest_date", "ingest_hour", "key", "offset")


@query
def stream_to_bronze_typed(spark, sf):
    """Courier records landed as typed columns, twice: the second time with a new field, a new part of the location
    and ``is_online`` as text, which its column cannot hold."""
    first = given.feed_records(_events(spark, sf)).filter(F.col("topic") == "couriers-raw")
    value = F.replace("value", F.lit('{"event_id"'), F.lit('{"channel":"app","event_id"'))
    value = F.replace(value, F.lit('"is_online":true'), F.lit('"is_online":"yes"'))
    value = F.replace(value, F.lit('"address":"Dock 1"'), F.lit('"address":"Dock 1","floor":3'))
    second = first.withColumns({"value": value, "offset": F.col("offset") + 10**12})
    landing, root, mark = (scratch(spark, n) for n in ("landing", "typed", "checkpoint"))
    for load in (first, second):
        load.write.mode("append").parquet(landing)
        source = feeds.read_landing(spark, landing)
        landed = F.to_date("record_timestamp")
        typed.land_typed(source, root, mark, COURIER_MESSAGE, day=landed).awaitTermination()
    return typed.read_typed(spark, root, COURIER_MESSAGE).select(
        F.col("record_offset").alias("offset"),
        "ingest_date",
        "event_id",
        "merchant_id",
        "courier_id",
        "order_id",
        F.col("current_location.latitude").alias("latitude"),
        F.col("current_location.floor").alias("floor"),
        "is_online",
        "channel",
        F.array_join(F.array_sort(F.map_keys("rescued")), ",").alias("rescued_fields"),
        F.col("rescued")["is_online"].alias("rescued_online"),
    )


@query
def stream_dedup(spark, sf):
    """Every record delivered three times, before and after two restarts of the stream; stored once."""
    records = given.feed_records(_events(spark, sf))
    landing, path, dead, mark = (scratch(spark, n) for n in ("landing", "messages", "dead-letters", "checkpoint"))
    for _ in range(3):
        records.write.mode("append").parquet(landing)
        jobs.land_once(feeds.read_landing(spark, landing), path, dead, mark).awaitTermination()
    return spark.read.parquet(path).select("topic", "message_id", "key", "offset")


def _courier_state(spark, sf):
    """Root of a state that took courier messages and a later correction of each (``is_online``)."""
    records = given.courier_records(_events(spark, sf))
    corrected = records.withColumns(
        {
            "value": F.replace("value", F.lit('"is_online":false'), F.lit('"is_online":true')),
            "offset": F.col("offset") + 10**12,
        }
    )
    landing = _stage(records, corrected)
    root, mark = scratch(spark, "state"), scratch(spark, "checkpoint")
    jobs.upsert_state(feeds.read_landing(spark, landing), root, mark).awaitTermination()
    return root


@query
def stream_upsert_state(spark, sf):
    """Courier messages and a later correction of each, kept as last write per key."""
    rows = jobs.read_state(spark, _courier_state(spark, sf), "couriers")
    return rows.drop("offset", "timestamp", "partition", "current_location")


@query
def state_point_lookup(spark, sf):
    """The stored rows of one courier, the one with the least id, out of one bucket of each run."""
    root = _courier_state(spark, sf)
    courier = str(_events(spark, sf).agg(F.min("user_id")).first()[0])
    rows = jobs.look_up_state(spark, root, "couriers", courier)
    return rows.drop("offset", "timestamp", "partition", "current_location")


@query
def stream_daily_counts(spark, sf):
    landing = _stage(given.bronze_orders(spark, sf))
    path, mark = scratch(spark, "daily"), scratch(spark, "checkpoint")
    bronze = spark.readStream.schema(BRONZE_ORDERS).parquet(landing)
    jobs.daily_counts(silver.silver_orders(bronze.drop("items")), path, mark).awaitTermination()
    return jobs.read_daily_counts(spark, path)


# ---------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------
@query
def dq_nulls(spark, sf):
    return quality.null_counts(
        given.bronze_orders(spark, sf),
        ["event_id", "order_id", "merchant_id", "total_amount", "estimated_delivery_time"],
    )


@query
def dq_times(spark, sf):
    return quality.time_checks(
        given.bronze_orders(spark, sf), ["event_timestamp", "estimated_delivery_time"], parse_time
    )


@query
def dq_amounts(spark, sf):
    return quality.amount_checks(given.bronze_orders(spark, sf))


@query
def dq_schema(spark, sf):
    return quality.schema_report(_orders(spark, sf), SILVER_ORDERS)


@query
def dq_delay_rule(spark, sf):
    return quality.count_failures(
        _orders(spark, sf),
        {"delay rule broken": quality.breaks_delay_rule(), "delayed": F.col("is_delayed")},
    )


@query
def dq_domains(spark, sf):
    return quality.domain_counts(
        given.bronze_orders(spark, sf),
        {
            "service_type": SERVICE_TYPES,
            "order_status": ORDER_STATUSES,
            "payment_method": PAYMENT_METHODS,
            "payment_status": PAYMENT_STATUSES,
        },
    )


@query
def dq_courier_domains(spark, sf):
    """Closed domains of courier events; every eleventh one names a vehicle that none may have."""
    vehicle = F.when(F.col("event_id").cast("bigint") % 11 == 0, F.lit("Sled")).otherwise(F.col("vehicle_type"))
    events = _couriers(spark, sf).withColumn("vehicle_type", vehicle)
    return quality.domain_counts(events, {"delivery_status": DELIVERY_STATUSES, "vehicle_type": VEHICLE_TYPES})


@query
def dq_order_totals(spark, sf):
    """Orders whose amount differs from the sum of their lines."""
    return quality.wrong_order_totals(_orders(spark, sf), silver.order_totals(given.item_messages(spark, sf)))


@query
def dq_ratings(spark, sf):
    reviews = messages.decode(
        given.feed_records(_events(spark, sf)).filter(F.col("topic") == "reviews-raw"), REVIEW_MESSAGE
    ).select("message.*")
    ranges = {f"{who}_rating": RATING_RANGE for who in ("courier", "merchant", "delivery")}
    return quality.domain_counts(reviews, {}, ranges)


@query
def dq_item_totals(spark, sf):
    return quality.wrong_item_totals(given.item_messages(spark, sf))


@query
def dq_missing_feeds(spark, sf):
    events = given.feed_events(_events(spark, sf)).filter(~F.col("torn"))
    return quality.missing_feeds(events, [f"{f}-raw" for f in FEEDS], "topic", "event_timestamp")


@query
def dq_freshness_volume(spark, sf):
    return quality.freshness_and_volume(_orders(spark, sf), minimum=5)


@query
def dq_gate_report(spark, sf):
    orders = _orders(spark, sf)
    return quality.gate_report(
        {
            "silver_orders": (orders, quality.silver_checks()),
            "silver_items": (_items(spark, sf), quality.item_checks()),
            "gold": (gold.fulfillment(orders), quality.gold_checks()),
        }
    )

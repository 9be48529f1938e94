"""The given star-schema tables seen as order and courier feeds.

Every column comes from the row it is derived from, so the order feed is a narrow projection of
``orders`` and item messages one of ``lineitem``: a line is one message with a list of one item. The arithmetic spreads the values over both sides of
every rule (late and on time, null, zero, negative and unreadable) and is repeated, independently and
on typed values, by the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.functions.keys import message_key, topic_name
from dispatchlake.schemas import (
    ADDRESS_PREFIX,
    BRONZE_ORDERS,
    ITEM,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    SERVICE_TYPES,
    VEHICLE_TYPES,
)


MESSAGE_LINES = 64  # line numbers in an order message
CHUNK_OFFSET = 1 << 40  # between the messages of one order


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(f"cast({index} as int) + 1"))


def _lake_time(ts: str) -> Column:
    """Text as a producer prints it: the fraction is left out at whole seconds."""
    return F.expr(
        f"case when {ts} = date_trunc('second', {ts}) then date_format({ts}, 'yyyy-MM-dd HH:mm:ss') "
        f"else date_format({ts}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') end"
    )


def _timed(orders: DataFrame) -> DataFrame:
    placed = orders.withColumn(
        "placed_at",
        F.expr(
            "timestampadd(MICROSECOND, ((o_orderkey * 7919) % 86400) * 1000000 + (o_orderkey % 10) * 100001, "
            "cast(o_orderdate as timestamp))"
        ),
    )
    return placed.withColumn(
        "promised_at",
        F.expr(
            "timestampadd(SECOND, (20 + (o_orderkey * 31) % 60) * 60 + (o_orderkey * 17) % 60, placed_at)"
        ),
    )


def order_columns() -> dict[str, Column]:
    """Feed columns over ``orders`` plus ``placed_at`` and ``promised_at``; items are added apart."""
    return {
        "event_id": F.col("o_orderkey").cast("string"),
        "event_timestamp": F.when(F.expr("o_orderkey % 73 = 0"), F.lit("not a time")).otherwise(
            _lake_time("placed_at")
        ),
        "order_id": F.when(F.expr("o_orderkey % 103 != 0"), F.col("o_orderkey").cast("string")),
        "merchant_id": F.when(F.expr("o_custkey % 61 != 0"), F.expr("cast(o_custkey % 100 as string)")),
        "customer_id": F.col("o_custkey").cast("string"),
        "service_type": _pick(SERVICE_TYPES, "o_orderkey % 4"),
        "order_status": F.expr(
            "case o_orderstatus when 'F' then 'delivered' when 'P' then 'cancelled' else 'en_route' end"
        ),
        "delivery_location": F.struct(
            F.expr("(o_custkey % 180) - 90 + 0.5D").alias("latitude"),
            F.expr("(o_custkey % 360) - 180 + 0.25D").alias("longitude"),
            F.expr("concat('No. ', o_custkey % 500, ' Market Street')").alias("address"),
        ),
        "delivery_fee": F.lit("1000.00"),
        "total_amount": F.expr(
            "case when o_orderkey % 97 = 0 then '0.00' when o_orderkey % 89 = 0 then '-5.00' "
            "when o_orderkey % 83 = 0 then 'n/a' when o_orderkey % 79 = 0 then null "
            "else cast(cast(o_totalprice as decimal(18,2)) as string) end"
        ),
        "estimated_delivery_time": F.when(F.expr("o_orderkey % 71 != 0"), _lake_time("promised_at")),
        "payment_method": F.when(F.expr("o_orderkey % 67 = 0"), F.lit("voucher")).otherwise(
            _pick(PAYMENT_METHODS, "o_orderkey % 4")
        ),
        "payment_status": _pick(PAYMENT_STATUSES, "o_orderkey div 4 % 4"),
    }


def line_item() -> Column:
    """A line as an item of the wire contract."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return F.struct(
        F.expr("concat('line-', l_linenumber)").alias("item_id"),
        F.expr("concat('Dish ', l_partkey % 200)").alias("name"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.round(F.try_divide(price, F.col("l_quantity").cast("decimal(18,0)")), 2).cast("string").alias("unit_price"),
        price.cast("string").alias("total_price"),
    )


def bronze_orders(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """The order feed without its item list."""
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    return _timed(orders).select(*[c.alias(n) for n, c in order_columns().items()])


def item_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order id and item list only, one message per line, for work that needs nothing else of the order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.array(line_item()).alias("items")
    )


def bronze_orders_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full order feed: an order comes once with each of its lines, however many it has.

    Orders without lines come once, with a null list (even keys) or an empty one (odd keys).
    """
    feed = order_columns()
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", line_item().alias("line"))
    joined = _timed(table(spark, sf_dir, "orders")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    empty = F.array().cast(T.ArrayType(ITEM))
    feed["items"] = F.when(F.col("line").isNotNull(), F.array("line")).otherwise(F.when(F.expr("o_orderkey % 2 = 1"), empty))
    return joined.select(*[feed[n].alias(n) for n in BRONZE_ORDERS.names])


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its lines as a JSON message delivered twice, the second time with its payment completed.

    A message holds the lines of up to ``MESSAGE_LINES`` line numbers; an order with more is several messages. Items and
    location carry fields that the contract does not name. Orders without lines come with a null
    list (even keys) or an empty one (odd keys).
    """
    item = line_item().withField("options", F.struct((F.col("l_quantity") > 25).alias("cold")))
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")]
    lists = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", F.expr(f"l_linenumber div {MESSAGE_LINES}").alias("chunk"), F.struct(*order, item.alias("item")).alias("line"))
        .groupBy("l_orderkey", "chunk")
        .agg(F.transform(F.array_sort(F.collect_list("line")), lambda line: line["item"]).alias("listed"))
    )
    feed = order_columns()
    empty = F.array().cast(lists.schema["listed"].dataType)
    feed["items"] = F.coalesce("listed", F.when(F.expr("o_orderkey % 2 = 1"), empty))
    feed["delivery_location"] = feed["delivery_location"].withField("floor", F.expr("cast(o_custkey % 40 as int)"))
    joined = _timed(table(spark, sf_dir, "orders")).join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    twice = joined.withColumn("delivery", F.explode(F.array(F.lit(0), F.lit(1))))
    feed["payment_status"] = F.when(F.col("delivery") == 1, F.lit("completed")).otherwise(feed["payment_status"])
    return twice.select(
        F.to_json(F.struct(*[c.alias(n) for n, c in feed.items()])).alias("value"),
        (F.coalesce("chunk", F.lit(0)) * CHUNK_OFFSET + F.col("o_orderkey") * 2 + F.col("delivery")).alias("offset"),
    )


# ---------------------------------------------------------------------------
# events as wire records
# ---------------------------------------------------------------------------
def courier_events(events: DataFrame) -> DataFrame:
    """Every event as a typed courier event."""
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.expr("cast(user_id % 100 as string)").alias("merchant_id"),
        F.col("user_id").cast("string").alias("courier_id"),
        F.expr("cast(event_id * 2 as string)").alias("order_id"),
        F.expr(
            "case event_type when 'click' then 'assigned' when 'view' then 'accepted' "
            "when 'signup' then 'picked_up' when 'purchase' then 'delivered' else 'cancelled' end"
        ).alias("delivery_status"),
        F.struct(
            F.expr("(event_id % 180) - 90 + 0.5D").alias("latitude"),
            F.expr("(event_id % 360) - 180 + 0.25D").alias("longitude"),
            F.expr("concat('Stop ', event_id % 500)").alias("address"),
        ).alias("current_location"),
        F.col("value").alias("battery_level"),
        _pick(VEHICLE_TYPES, "event_id % 3").alias("vehicle_type"),
        F.expr("event_id % 5 != 0").alias("is_online"),
    )


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _landed(offset: Column) -> Column:
    """Landing clock of a backlog drained at a steady pace (360 ms per record)."""
    return F.timestamp_millis(F.lit(1706745600000).cast("bigint") + offset * 360)


def _torn(value: Column, broken: Column) -> Column:
    """A message whose closing brace was lost."""
    return F.when(broken, F.expr("left(value, length(value) - 1)")).otherwise(value)


def courier_records(events: DataFrame) -> DataFrame:
    """Every event as a record of the courier topic; ``error`` events arrive torn."""
    typed = courier_events(events)
    message = typed.withColumn("event_timestamp", _iso(F.col("event_timestamp")))
    return message.select(
        F.lit(topic_name("couriers")).alias("topic"),
        F.col("courier_id").alias("key"),
        F.to_json(F.struct(*typed.columns)).alias("value"),
        F.col("event_id").cast("bigint").alias("offset"),
        _landed(F.col("event_id").cast("bigint")).alias("timestamp"),
        (F.col("delivery_status") == "cancelled").alias("torn"),
    ).select("topic", "key", _torn(F.col("value"), F.col("torn")).alias("value"), "offset", "timestamp")


def feed_events(events: DataFrame) -> DataFrame:
    """Every event routed to one of the four topics by its type, with the ids a message key can use."""
    feed = F.expr(
        "case event_type when 'purchase' then 'orders' when 'view' then 'couriers' "
        "when 'signup' then 'merchants' when 'click' then 'reviews' else 'couriers' end"
    )
    return events.select(
        F.concat(feed, F.lit("-raw")).alias("topic"),
        F.col("event_id").cast("string").alias("event_id"),
        F.expr("cast(event_id * 2 as string)").alias("order_id"),
        F.expr("cast(user_id % 100 as string)").alias("merchant_id"),
        # every seventh message lost its courier, so its key falls back to the event id
        F.when(F.expr("event_id % 7 != 0"), F.col("user_id").cast("string")).alias("courier_id"),
        F.expr("concat('r', event_id)").alias("review_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.expr("cast(value as decimal(18,2))").alias("amount"),
        F.col("props"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("event_id").alias("offset"),
        (F.col("event_type") == "error").alias("torn"),
    )


def feed_records(events: DataFrame) -> DataFrame:
    """The four topics as raw records: topic, key, JSON value, offset, landing time."""
    routed = feed_events(events)
    contract = {
        "orders-raw": F.struct(
            "event_id",
            _lake_time("event_timestamp").alias("event_timestamp"),
            "order_id",
            "merchant_id",
            "customer_id",
            F.lit("groceries").alias("service_type"),
            F.lit("created").alias("order_status"),
            F.array(
                F.struct(
                    F.lit("line-1").alias("item_id"),
                    F.lit("Dish 7").alias("name"),
                    F.lit(2).cast("bigint").alias("quantity"),
                    F.col("amount").cast("string").alias("unit_price"),
                    (F.col("amount") * 2).cast("string").alias("total_price"),
                )
            ).alias("items"),
            F.struct(
                F.lit(10.5).alias("latitude"), F.lit(20.25).alias("longitude"), F.lit("Dock 1").alias("address")
            ).alias("delivery_location"),
            F.lit("1000.00").alias("delivery_fee"),
            (F.col("amount") * 2).cast("string").alias("total_amount"),
            F.date_format(F.col("event_timestamp") + F.expr("interval 45 minutes"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(
                "estimated_delivery_time"
            ),
            F.lit("card").alias("payment_method"),
            F.lit("pending").alias("payment_status"),
        ),
        "couriers-raw": F.struct(
            "event_id",
            _iso(F.col("event_timestamp")).alias("event_timestamp"),
            "merchant_id",
            "courier_id",
            "order_id",
            F.lit("en_route").alias("delivery_status"),
            F.struct(
                F.lit(10.5).alias("latitude"), F.lit(20.25).alias("longitude"), F.lit("Dock 1").alias("address")
            ).alias("current_location"),
            F.lit("Van").alias("vehicle_type"),
            F.lit(True).alias("is_online"),
        ),
        "merchants-raw": F.struct(
            "event_id",
            _iso(F.col("event_timestamp")).alias("event_timestamp"),
            "merchant_id",
            "order_id",
            F.expr("cast(offset % 31 + 15 as int)").alias("average_preparation_time"),
            F.lit(True).alias("is_open"),
            F.expr("cast(offset % 10 + 1 as int)").alias("current_load"),
        ),
        "reviews-raw": F.struct(
            "review_id",
            "order_id",
            "customer_id",
            F.expr("cast(offset % 5 + 1 as int)").alias("courier_rating"),
            F.expr("cast(offset % 7 as int)").alias("merchant_rating"),
            F.expr("cast(offset % 4 + 1 as int)").alias("delivery_rating"),
            _iso(F.col("event_timestamp")).alias("feedback_timestamp"),
            F.col("props").alias("comments"),
        ),
    }
    value = F.coalesce(*[F.when(F.col("topic") == t, F.to_json(s)) for t, s in contract.items()])
    return routed.select(
        "topic",
        message_key(F.col("topic"), routed.columns).alias("key"),
        value.alias("value"),
        "offset",
        _landed(F.col("offset")).alias("timestamp"),
        "torn",
    ).select("topic", "key", _torn(F.col("value"), F.col("torn")).alias("value"), "offset", "timestamp")


def merchant_rows(supplier: DataFrame) -> DataFrame:
    """Suppliers as scraped merchant rows, the address still carrying its label."""
    return supplier.select(
        F.col("s_name").alias("Name"),
        F.concat(F.lit(ADDRESS_PREFIX), F.lit("Lot "), F.col("s_suppkey"), F.lit(", District "), F.col("s_nationkey"))
        .alias("Address"),
    )

"""Event contracts, table layouts and closed value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Wire spellings that producers send and consumers compare with.
# ---------------------------------------------------------------------------
SERVICE_TYPES = ["food_delivery", "packae_delivery", "pharmacy", "groceries"]
ORDER_STATUSES = [
    "created",
    "accepted",
    "rejected",
    "preparing",
    "ready_for_pickup",
    "picked_up",
    "en_route",
    "arrived",
    "delivered",
    "cancelled",
]
DELIVERY_STATUSES = [
    "assigned",
    "accepted",
    "at_pickup",
    "picked_up",
    "en_route",
    "at_dropoff",
    "delivered",
    "cancelled",
]
PAYMENT_METHODS = ["card", "cash", "wallet", "bank_transfer"]
PAYMENT_STATUSES = ["pending", "completed", "failed", "refunded"]
VEHICLE_TYPES = ["Bicycle", "Motorcycle", "Van"]
FEEDS = ["orders", "couriers", "merchants", "reviews"]
FEED_KEYS = {
    "orders": "order_id",
    "merchants": "merchant_id",
    "couriers": "courier_id",
    "reviews": "review_id",
}
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
ADDRESS_PREFIX = "Address: "
DELAY_THRESHOLD_MINUTES = 45
PROMISED_MINUTES = 45
RATING_RANGE = (1, 5)

LOCATION = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("address", T.StringType()),
    ]
)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


ITEM = T.StructType(
    [
        *_strings("item_id", "name"),
        # Producers send 2 as well as 2.0; the parse takes both, silver casts.
        T.StructField("quantity", T.DoubleType()),
        *_strings("unit_price", "total_price"),
    ]
)

# Orders as landed: money and times are still text.
BRONZE_ORDERS = T.StructType(
    [
        *_strings(
            "event_id",
            "event_timestamp",
            "order_id",
            "merchant_id",
            "customer_id",
            "service_type",
            "order_status",
        ),
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("delivery_location", LOCATION),
        *_strings(
            "delivery_fee",
            "total_amount",
            "estimated_delivery_time",
            "payment_method",
            "payment_status",
        ),
    ]
)

# Orders on the wire may name a courier; the lake table does not keep it.
ORDER_MESSAGE = T.StructType([*BRONZE_ORDERS.fields, *_strings("courier_id")])

COURIER_MESSAGE = T.StructType(
    [
        *_strings(
            "event_id",
            "event_timestamp",
            "merchant_id",
            "courier_id",
            "order_id",
            "delivery_status",
        ),
        T.StructField("current_location", LOCATION),
        T.StructField("battery_level", T.DoubleType()),
        *_strings("vehicle_type"),
        T.StructField("is_online", T.BooleanType()),
    ]
)

MERCHANT_MESSAGE = T.StructType(
    [
        *_strings("event_id", "event_timestamp", "merchant_id", "order_id"),
        T.StructField("average_preparation_time", T.IntegerType()),
        T.StructField("is_open", T.BooleanType()),
        T.StructField("current_load", T.IntegerType()),
    ]
)

REVIEW_MESSAGE = T.StructType(
    [
        *_strings("review_id", "order_id", "customer_id"),
        T.StructField("courier_rating", T.IntegerType()),
        T.StructField("merchant_rating", T.IntegerType()),
        T.StructField("delivery_rating", T.IntegerType()),
        *_strings("feedback_timestamp", "comments"),
    ]
)

# One schema that reads a message of any feed; fields of other feeds stay null.
ANY_MESSAGE = T.StructType(
    list(
        {
            field.name: field
            for contract in (ORDER_MESSAGE, COURIER_MESSAGE, MERCHANT_MESSAGE, REVIEW_MESSAGE)
            for field in contract.fields
        }.values()
    )
)

# What every raw feed record carries around its JSON value.
FEED_RECORD = T.StructType(
    [
        *_strings("topic", "key", "value"),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# A record as it is read: offsets only compare inside a partition. Files without partitions give null.
READ_RECORD = T.StructType([*FEED_RECORD.fields, T.StructField("partition", T.IntegerType())])

# The raw landing lake: a record and the partition columns it is stored under.
LANDED_RECORD = T.StructType(
    [
        *READ_RECORD.fields,
        T.StructField("ingest_date", T.DateType()),
        T.StructField("ingest_hour", T.IntegerType()),
    ]
)

MERCHANT_CSV = T.StructType(_strings("Name", "Address"))

# Silver orders without the nested item list: the warehouse layout.
SILVER_ORDERS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        *_strings("order_id", "merchant_id", "customer_id", "service_type", "order_status"),
        T.StructField("delivery_fee", T.FloatType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("estimated_delivery_time", T.TimestampType()),
        *_strings("payment_method", "payment_status"),
        T.StructField("event_date", T.DateType()),
        T.StructField("delivery_latitude", T.DoubleType()),
        T.StructField("delivery_longitude", T.DoubleType()),
        T.StructField("delivery_time_minutes", T.DoubleType()),
        T.StructField("is_delayed", T.BooleanType()),
    ]
)

SILVER_ITEMS = T.StructType(
    [
        *_strings("order_id", "item_id", "name"),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_price", T.DoubleType()),
    ]
)

OPS_ORDERS = [
    "event_id",
    "event_timestamp",
    "order_id",
    "merchant_id",
    "courier_id",
    "customer_id",
    "service_type",
    "order_status",
    "items",
    "delivery_location",
    "delivery_fee",
    "total_amount",
    "estimated_delivery_time",
    "payment_method",
    "payment_status",
]
OPS_COURIERS = [
    "event_id",
    "event_timestamp",
    "merchant_id",
    "courier_id",
    "order_id",
    "delivery_status",
    "current_location",
    "vehicle_type",
    "is_online",
]

_WRITTEN = [
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
]


def _state(columns: list[str], typed: dict[str, T.DataType]) -> T.StructType:
    """A keyed table: text columns but for the typed ones, and what orders the writes."""
    return T.StructType([T.StructField(c, typed.get(c, T.StringType())) for c in columns] + _WRITTEN)


STATE_SCHEMAS = {
    "orders": _state(
        OPS_ORDERS,
        {
            "event_timestamp": T.TimestampType(),
            "estimated_delivery_time": T.TimestampType(),
            "delivery_fee": T.DoubleType(),
            "total_amount": T.DoubleType(),
        },
    ),
    "couriers": _state(OPS_COURIERS, {"event_timestamp": T.TimestampType(), "is_online": T.BooleanType()}),
}

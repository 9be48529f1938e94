"""Raw feed records to typed rows: decode, route, split off what cannot be used, shape for the keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.functions.keys import DEFAULT_TOPIC_PATTERN, message_key, topic_name
from dispatchlake.functions.parsing import parse_iso_time, to_double
from dispatchlake.schemas import (
    ANY_MESSAGE,
    COURIER_MESSAGE,
    OPS_COURIERS,
    OPS_ORDERS,
    ORDER_MESSAGE,
)

CORRUPT = "_corrupt_record"
HANDLED_FEEDS = ("orders", "couriers")


def decode(records: DataFrame, contract: T.StructType = ANY_MESSAGE, value: str = "value") -> DataFrame:
    """Records with their JSON value parsed into ``message``; an unreadable value lands in its corrupt field.

    The parse goes through a one-element explode: filters on parsed fields then stay above it. Pushed
    below, each of them would parse the text once more.
    """
    schema = T.StructType([*contract.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return records.select("*", F.explode(F.array(parsed)).alias("message"))


def unreadable() -> Column:
    return F.col("message").isNull() | F.col(f"message.{CORRUPT}").isNotNull()


def _corrupt_field(messages: DataFrame) -> list[Column]:
    """The reason of unreadable values, for messages that came out of :func:`decode`."""
    if CORRUPT not in messages.schema["message"].dataType.names:
        return []
    return [F.when(unreadable(), F.lit("malformed json"))]


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded records as readable ones, and dead letters with the raw value and a reason."""
    raw = [c for c in decoded.columns if c != "message"]
    dead = decoded.filter(unreadable()).select(*raw, F.lit("malformed json").alias("reason"))
    return decoded.filter(~unreadable()), dead


def split_dead_letters(records: DataFrame, contract: T.StructType = ANY_MESSAGE) -> tuple[DataFrame, DataFrame]:
    """Raw records decoded and split, see :func:`split_decoded`."""
    return split_decoded(decode(records, contract))


def handler(topic: Column, pattern: str = DEFAULT_TOPIC_PATTERN) -> Column:
    """The keyed table that takes a topic's records; other topics have none."""
    cases = [F.when(topic == F.lit(topic_name(f, pattern)), F.lit(f)) for f in HANDLED_FEEDS]
    return F.coalesce(*cases, F.lit("unhandled"))


def route_counts(records: DataFrame, pattern: str = DEFAULT_TOPIC_PATTERN) -> DataFrame:
    """Records per topic and the handler that takes them."""
    return records.groupBy("topic", handler(F.col("topic"), pattern).alias("handler")).agg(
        F.count(F.lit(1)).alias("records")
    )


def envelope(events: DataFrame, payload: list[str], pattern: str = DEFAULT_TOPIC_PATTERN) -> DataFrame:
    """Events as publishable records: topic, key, JSON value, epoch milliseconds.

    The result writes with ``df.write.format("kafka")``; ``timestamp_ms`` is for logs and checks, as the
    sink stamps records itself.
    """
    return events.select(
        "topic",
        message_key(F.col("topic"), events.columns, pattern).alias("key"),
        F.to_json(F.struct(*payload)).alias("value"),
        F.unix_millis("event_timestamp").alias("timestamp_ms"),
    )


def _reason(messages: DataFrame, required: dict[str, Column]) -> Column:
    """Why a message cannot be stored: unreadable, or its first required value that is absent. Else null."""
    absent = [F.when(c.isNull(), F.lit(f"bad or missing {n}")) for n, c in required.items()]
    return F.coalesce(*_corrupt_field(messages), *absent)


def as_text(contract: T.StructType) -> T.StructType:
    """The contract with its nested values as text: one parse then gives them exactly as they were sent."""
    nested = (T.StructType, T.ArrayType)
    return T.StructType(
        [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, nested) else f for f in contract.fields]
    )


ORDER_TEXT, COURIER_TEXT = as_text(ORDER_MESSAGE), as_text(COURIER_MESSAGE)


def _nested(field: str, contract: T.StructType) -> Column:
    """A nested value as sent; text that is no object or list of the contract is none."""
    opened = "[" if isinstance(contract[field].dataType, T.ArrayType) else "{"
    sent = F.col(f"message.{field}")
    return F.when(sent.startswith(opened), sent)


def _carried(messages: DataFrame) -> list[str]:
    """Columns of a record that its dead letter keeps, so that it can be replayed."""
    return [c for c in ("topic", "partition", "key", "value", "timestamp") if c in messages.columns]


def shape_orders(messages: DataFrame) -> DataFrame:
    """Order messages as rows of the keyed order table, plus ``reason`` where a row cannot be stored.

    Nested values stay the JSON text that was sent, also the parts that no contract names. Money becomes
    double. Messages are decoded with ``ORDER_TEXT``; ``offset`` is kept to order writes to the same key.
    """
    m = {f: F.col(f"message.{f}") for f in ORDER_MESSAGE.names}
    shaped = {
        **m,
        "event_timestamp": parse_iso_time(m["event_timestamp"]),
        "estimated_delivery_time": parse_iso_time(m["estimated_delivery_time"]),
        "items": F.coalesce(_nested("items", ORDER_MESSAGE), F.lit("[]")),
        "delivery_location": _nested("delivery_location", ORDER_MESSAGE),
        "delivery_fee": to_double(m["delivery_fee"]),
        "total_amount": to_double(m["total_amount"]),
    }
    required = ("order_id", "event_timestamp", "delivery_location", "delivery_fee", "total_amount")
    return messages.select(
        *[shaped[c].alias(c) for c in OPS_ORDERS],
        "offset",
        F.struct(*_carried(messages)).alias("record"),
        _reason(messages, {c: shaped[c] for c in required}).alias("reason"),
    )


def shape_couriers(messages: DataFrame) -> DataFrame:
    """Courier messages, decoded with ``COURIER_TEXT``, as rows of the keyed courier table; it has no battery level."""
    m = {f: F.col(f"message.{f}") for f in COURIER_MESSAGE.names}
    shaped = {
        **m,
        "event_timestamp": parse_iso_time(m["event_timestamp"]),
        "current_location": _nested("current_location", COURIER_MESSAGE),
    }
    required = ("courier_id", "event_timestamp", "current_location")
    return messages.select(
        *[shaped[c].alias(c) for c in OPS_COURIERS],
        "offset",
        F.struct(*_carried(messages)).alias("record"),
        _reason(messages, {c: shaped[c] for c in required}).alias("reason"),
    )


def storable(shaped: DataFrame, order: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Rows of a keyed table, with the parts of their record that order writes to the same key."""
    good = shaped.filter(F.col("reason").isNull())
    carried = [F.col(f"record.{c}").alias(c) for c in order if c != "offset"]
    return good.select(*[c for c in shaped.columns if c not in ("record", "reason")], *carried)


def rejected(shaped: DataFrame) -> DataFrame:
    return shaped.filter(F.col("reason").isNotNull())


def dead_letters(shaped: DataFrame) -> DataFrame:
    """Rejected messages as the records they came in, with the reason."""
    return rejected(shaped).select("record.*", "offset", "reason")


def with_order(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Events with the merchant of the order they name; ``matched`` tells unknown orders apart."""
    named = orders.select("order_id", F.col("merchant_id").alias("order_merchant_id"), F.lit(True).alias("found"))
    return events.join(named, "order_id", "left").withColumn("matched", F.coalesce("found", F.lit(False))).drop("found")

import json

import pytest
from pyspark.sql import functions as F

from dispatchlake.functions.keys import landing_path, message_key, topic_name
from dispatchlake.functions.parsing import parse_iso_time, parse_time
from dispatchlake.operators import inference, messages
from dispatchlake.schemas import COURIER_MESSAGE, ORDER_MESSAGE

ORDER = {
    "event_id": "e1",
    "event_timestamp": "2025-02-10T10:00:00Z",
    "order_id": "o1",
    "merchant_id": "m1",
    "courier_id": "c1",
    "customer_id": "u1",
    "service_type": "groceries",
    "order_status": "created",
    "items": [{"item_id": "i1", "qty": 2}],
    "delivery_location": {"lat": 1.5, "lon": 2.5},
    "delivery_fee": 5.5,
    "total_amount": 20,
    "estimated_delivery_time": "2025-02-10T11:30:00+01:00",
    "payment_method": "card",
    "payment_status": "pending",
}


def records(spark, *values, topic="orders-raw"):
    rows = [(topic, "k", v if isinstance(v, str) else json.dumps(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, key string, value string, offset long")


def shaped(spark, *values):
    return messages.shape_orders(messages.decode(records(spark, *values), messages.ORDER_TEXT))


def test_order_message(spark):
    row = messages.storable(shaped(spark, ORDER)).first()
    assert str(row.event_timestamp) == "2025-02-10 10:00:00"
    assert str(row.estimated_delivery_time) == "2025-02-10 10:30:00"
    assert (row.delivery_fee, row.total_amount, row.courier_id) == (5.5, 20.0, "c1")
    assert json.loads(row["items"]) == ORDER["items"]


def test_absent_optional_fields_get_defaults(spark):
    row = messages.storable(shaped(spark, {k: v for k, v in ORDER.items() if k not in ("items", "courier_id")})).first()
    assert row["items"] == "[]" and row.courier_id is None


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"order_id": None}, "bad or missing order_id"),
        ({"event_timestamp": "x"}, "bad or missing event_timestamp"),
        ({"delivery_location": None}, "bad or missing delivery_location"),
        ({"total_amount": "ten"}, "bad or missing total_amount"),
        ({"delivery_fee": None}, "bad or missing delivery_fee"),
    ],
)
def test_unstorable_orders(spark, change, reason):
    df = shaped(spark, {**ORDER, **change})
    assert messages.storable(df).count() == 0
    assert messages.rejected(df).first().reason == reason


def test_nested_values_stay_as_sent(spark):
    sent = {**ORDER, "items": [{"item_id": "i", "qty": 2, "quantity": 2.0}], "delivery_location": {"lat": 1.5, "lon": 2}}
    row = messages.storable(shaped(spark, sent)).first()
    assert json.loads(row["items"]) == sent["items"] and json.loads(row.delivery_location) == sent["delivery_location"]


def test_dead_letters_can_be_replayed(spark):
    dead = messages.dead_letters(shaped(spark, {**ORDER, "order_id": None}, "{")).collect()
    assert {r.offset for r in dead} == {0, 1} and all(r.topic == "orders-raw" and r.key == "k" for r in dead)
    assert {r.value for r in dead} >= {"{"}


def test_malformed_value_is_a_dead_letter(spark):
    df = records(spark, ORDER, '{"event_id": "e2", ', "[1, 2", "", None)
    good, dead = messages.split_dead_letters(df, ORDER_MESSAGE)
    assert [r.offset for r in good.collect()] == [0]
    assert sorted(r.offset for r in dead.collect()) == [1, 2, 3, 4]
    assert shaped(spark, "{").first().reason == "malformed json"


def test_minimal_message_is_readable(spark):
    good, dead = messages.split_dead_letters(records(spark, {"event_id": "1", "merchant_id": "m"}))
    assert good.count() == 1 and dead.count() == 0


def test_courier_message_drops_battery(spark):
    value = {
        "event_id": "e", "event_timestamp": "2025-02-10T10:00:00Z", "courier_id": "c", "order_id": "o",
        "delivery_status": "assigned", "current_location": {"latitude": 1.0, "longitude": 2.0, "address": "a"},
        "battery_level": 0.5, "vehicle_type": "Van", "is_online": True,
    }
    row = messages.shape_couriers(messages.decode(records(spark, value), messages.COURIER_TEXT)).first()
    assert "battery_level" not in row.asDict()
    assert json.loads(row.current_location) == value["current_location"] and row.is_online is True


def test_routing(spark):
    topics = spark.createDataFrame([("orders-raw",), ("couriers-raw",), ("reviews-raw",), ("x",)], "topic string")
    got = {r.topic: r.h for r in topics.select("topic", messages.handler(F.col("topic")).alias("h")).collect()}
    assert got == {"orders-raw": "orders", "couriers-raw": "couriers", "reviews-raw": "unhandled", "x": "unhandled"}


def test_keys_and_paths(spark):
    df = spark.createDataFrame(
        [("orders-raw", "e", "o", None), ("couriers-raw", "e", "o", None), ("other", "e", "o", "c")],
        "topic string, event_id string, order_id string, courier_id string",
    )
    assert [r.k for r in df.select(message_key(F.col("topic"), df.columns).alias("k")).collect()] == ["o", "e", "e"]
    path = spark.sql("select timestamp'2025-02-10 07:05:09' t").select(landing_path(F.lit("a.b"), F.col("t")).alias("p"))
    assert path.first().p == "bronze/a/b/2025/02/10/07/0509.parquet"
    assert topic_name("orders", "shop.{feed}") == "shop.orders"


def test_time_spellings(spark):
    df = spark.createDataFrame(
        [("2025-02-10 10:00:00.123456",), ("2025-02-10 10:00:00",), ("2025-02-10T10:00:00Z",), ("no",), (None,)], "s string"
    )
    lake = [str(r[0]) for r in df.select(parse_time("s").cast("string")).collect()]
    assert lake == ["2025-02-10 10:00:00.123456", "2025-02-10 10:00:00", "None", "None", "None"]
    iso = [str(r[0]) for r in df.select(parse_iso_time("s").cast("string")).collect()]
    assert iso == ["2025-02-10 10:00:00.123456", "2025-02-10 10:00:00", "2025-02-10 10:00:00", "None", "None"]


def test_inference_merges_over_all_rows(spark):
    df = records(
        spark,
        {"flag": True, "items": [], "note": None, "n": 1, "loc": {"lat": 1}},
        {"flag": False, "items": [{"id": "a", "qty": 2}], "note": None, "n": 2.5, "loc": {"lat": 1.5}},
        "{broken",
    )
    ddl = inference.infer_schema(df)
    row = df.select(F.from_json("value", ddl).alias("m")).select("m.*").collect()[1]
    assert row.flag is False and row["items"][0].qty == 2 and row.n == 2.5 and row.loc.lat == 1.5
    assert dict(df.select(F.from_json("value", ddl).alias("m")).select("m.*").dtypes)["note"] == "string"


def test_event_lookup_flags_unknown_orders(spark):
    events = spark.createDataFrame([("e1", "o1"), ("e2", "o9"), ("e3", None)], "event_id string, order_id string")
    orders = spark.createDataFrame([("o1", "m1")], "order_id string, merchant_id string")
    got = {r.event_id: (r.order_merchant_id, r.matched) for r in messages.with_order(events, orders).collect()}
    assert got == {"e1": ("m1", True), "e2": (None, False), "e3": (None, False)}

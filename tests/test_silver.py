from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import SOUP, bronze

from dispatchlake.operators import quality, silver
from dispatchlake.schemas import BRONZE_ORDERS, SILVER_ITEMS, SILVER_ORDERS


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_layouts(spark):
    assert len(BRONZE_ORDERS) == 14
    orders = silver.silver_orders(bronze(spark, {}))
    assert {f.name: f.dataType for f in orders.drop("items").schema} == {f.name: f.dataType for f in SILVER_ORDERS}
    items = silver.order_items(bronze(spark, {}))
    assert {f.name: f.dataType for f in items.schema} == {f.name: f.dataType for f in SILVER_ITEMS}


def test_plain_order(spark):
    row = one(silver.silver_orders(bronze(spark, {})))
    assert row.delivery_time_minutes == 30 and row.is_delayed is False
    assert row.event_date == date(2025, 2, 10)
    assert (row.delivery_latitude, row.delivery_longitude) == (-3.25, 41.5)
    assert row.order_status == "delivered" and row.delivery_fee == 5.0


@pytest.mark.parametrize(
    "eta, minutes, delayed",
    [
        ("2025-02-10 10:45:00.000000", 45, False),
        ("2025-02-10 10:45:29.000000", 45, False),
        ("2025-02-10 10:45:30.000000", 46, True),
        ("2025-02-10 10:46:00", 46, True),
        ("2025-02-10 09:50:00.000000", -10, False),
        (None, None, False),
        ("soon", None, False),
    ],
)
def test_minutes_and_delay(spark, eta, minutes, delayed):
    row = one(silver.silver_orders(bronze(spark, {"estimated_delivery_time": eta})))
    assert row.delivery_time_minutes == minutes and row.is_delayed is delayed


def test_fractions_are_cut_before_subtracting(spark):
    row = one(
        silver.silver_orders(
            bronze(
                spark,
                {
                    "event_timestamp": "2025-02-10 10:00:00.900000",
                    "estimated_delivery_time": "2025-02-10 10:45:30.100000",
                },
            )
        )
    )
    assert row.delivery_time_minutes == 46


def test_unreadable_event_time_is_kept_without_day(spark):
    row = one(silver.silver_orders(bronze(spark, {"event_timestamp": "garbage"})))
    assert row.event_timestamp is None and row.event_date is None and row.is_delayed is False


def test_validity_filter_drops_without_failing(spark):
    bad = [
        {"order_id": None},
        {"merchant_id": None},
        {"total_amount": None},
        {"total_amount": "0"},
        {"total_amount": "-1"},
        {"total_amount": "abc"},
    ]
    assert silver.silver_orders(bronze(spark, *bad)).count() == 0
    assert silver.silver_orders(bronze(spark, *bad, {"total_amount": "0.01"})).count() == 1


def test_items(spark):
    rows = silver.order_items(bronze(spark, {"items": [SOUP, SOUP]}, {"items": []}, {"items": None})).collect()
    assert len(rows) == 2
    assert (rows[0].quantity, rows[0].unit_price, rows[0].total_price) == (1, 4.2, 4.2)
    assert silver.order_items(bronze(spark, {"items": []}, {"items": None}), keep_empty=True).count() == 2


def test_items_given_as_maps(spark):
    orders = spark.createDataFrame(
        [("1", [{"item_id": "a", "quantity": "2", "unit_price": "1.5", "total_price": "3.0", "name": "x"}])],
        "order_id string, items array<map<string,string>>",
    )
    row = one(silver.order_items(orders))
    assert (row.item_id, row.quantity, row.unit_price, row.total_price) == ("a", 2, 1.5, 3.0)


def test_order_totals_skip_unreadable_prices(spark):
    broken = {**SOUP, "total_price": "?"}
    totals = silver.order_totals(bronze(spark, {"items": [SOUP, SOUP, broken]}, {"order_id": "2", "items": None}))
    assert {r.order_id: float(r.items_total) for r in totals.collect()} == {"o-1": 8.4, "2": 0.0}


def test_bronze_read_fills_absent_columns(spark, folder):
    from dispatchlake.sources.feeds import read_bronze_orders

    bronze(spark, {}).drop("items").write.parquet(folder("b") + "/2025/02/10")
    row = one(read_bronze_orders(spark, folder("b") + "/2025/02/*"))
    assert row["items"] is None and row.order_id == "o-1"


def test_quality_counts(spark):
    feed = bronze(spark, {}, {"order_id": None}, {"total_amount": "-1"}, {"total_amount": "x"}, {"event_timestamp": "x"})
    nulls = {r.check: r.failed for r in quality.null_counts(feed, ["order_id", "merchant_id"]).collect()}
    assert nulls == {"order_id is null": 1, "merchant_id is null": 0}
    amounts = {r.check: r.failed for r in quality.amount_checks(feed).collect()}
    assert amounts == {"total_amount <= 0": 1, "total_amount not a number": 1}


def test_schema_report_names_missing_and_surplus(spark):
    df = spark.createDataFrame([(1, None)], "order_id int, extra string")
    rows = {r.column: r for r in quality.schema_report(df, SILVER_ITEMS).collect()}
    assert rows["order_id"].actual_type == "int" and not rows["order_id"].matches
    assert rows["name"].actual_type is None and rows["name"].nulls is None
    assert rows["extra"].expected_type is None and rows["extra"].nulls == 1


def test_gate_stops_on_failure(spark):
    orders = silver.silver_orders(bronze(spark, {}, {"event_timestamp": "x"}))
    report = quality.gate_report({"silver": (orders, quality.silver_checks())})
    with pytest.raises(quality.QualityGateError, match="event_timestamp is null on 1 rows"):
        quality.enforce(report)
    good = quality.gate_report({"silver": (orders.filter(F.col("event_date").isNotNull()), quality.silver_checks())})
    quality.enforce(good)


def test_delay_rule_violations(spark):
    rows = spark.createDataFrame(
        [(46.0, True), (46.0, False), (45.0, True), (None, False), (50.0, None)],
        "delivery_time_minutes double, is_delayed boolean",
    )
    assert rows.filter(quality.breaks_delay_rule()).count() == 3


def test_domains_and_ranges(spark):
    df = spark.createDataFrame([("card", 5), ("gold", 6), (None, None)], "payment_method string, rating int")
    out = {
        (r.field, r.value): r.in_domain
        for r in quality.domain_counts(df, {"payment_method": ["card"]}, {"rating": (1, 5)}).collect()
    }
    assert out == {
        ("payment_method", "card"): True,
        ("payment_method", "gold"): False,
        ("payment_method", None): False,
        ("rating", "5"): True,
        ("rating", "6"): False,
        ("rating", None): True,
    }


def test_whole_and_fractional_quantities_are_read(spark):
    from dispatchlake.operators import messages
    from dispatchlake.schemas import BRONZE_ORDERS

    rows = [('{"order_id":"1","items":[{"quantity":2.0},{"quantity":3}]}',)]
    decoded = messages.decode(spark.createDataFrame(rows, "value string"), BRONZE_ORDERS)
    assert decoded.filter(messages.unreadable()).count() == 0
    items = silver.order_items(decoded.select("message.*"))
    assert sorted(r.quantity for r in items.collect()) == [2, 3]


def test_every_line_is_an_item(spark, sf_dir):
    from dispatchlake.sources import driver_tables as given

    lines = given.table(spark, sf_dir, "lineitem").count()
    assert silver.order_items(given.item_messages(spark, sf_dir)).count() == lines

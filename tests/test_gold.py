from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import SOUP, bronze

from dispatchlake.operators import gold, silver


def orders(spark, *changes):
    return silver.silver_orders(bronze(spark, *changes))


def by_day(df):
    return {r.event_date: r for r in df.collect()}


def at(day, hour=10, eta=30):
    return {
        "event_timestamp": f"2025-02-{day:02d} {hour:02d}:00:00",
        "estimated_delivery_time": f"2025-02-{day:02d} {hour:02d}:{eta:02d}:00",
    }


def test_status_case_does_not_matter(spark):
    row = gold.fulfillment(
        orders(spark, *[{"order_status": s} for s in ("delivered", "DELIVERED", "Delivered", "cancelled")])
    ).first()
    assert (row.total_orders, row.delivered_orders, row.fulfillment_rate) == (4, 3, 75.0)
    assert (row.cancelled_orders, row.cancellation_rate, row.delay_rate) == (1, 25.0, 0.0)


def test_day_without_deliveries(spark):
    df = orders(spark, {**at(1), "order_status": "created"}, at(2))
    assert by_day(gold.fulfillment(df))[date(2025, 2, 1)].fulfillment_rate == 0.0
    assert set(by_day(gold.delivery_time(df))) == {date(2025, 2, 2)}
    assert set(by_day(gold.eta_accuracy(df))) == {date(2025, 2, 2)}


def test_delivery_time_split(spark):
    row = gold.delivery_time(orders(spark, at(1, eta=50), at(1, eta=59), at(1, eta=10), at(1, eta=11))).first()
    assert (row.avg_delivery_time, row.avg_delayed_delivery_time, row.avg_ontime_delivery_time) == (32.5, 54.5, 10.5)
    late = gold.delivery_time(orders(spark, at(1, eta=50))).first()
    assert late.avg_ontime_delivery_time is None


def test_eta_deviation(spark):
    df = orders(spark, at(1, eta=40), at(1, eta=52))
    row = gold.eta_accuracy(df).first()
    assert (row.avg_eta_deviation, row.delayed_deliveries, row.delay_rate) == (6.0, 1, 50.0)
    assert gold.eta_accuracy(df, promised_minutes=40).first().avg_eta_deviation == 6.0


def test_rates_round_half_up(spark):
    row = gold.fulfillment(orders(spark, *([{}] * 1 + [{"order_status": "created"}] * 31))).first()
    assert row.fulfillment_rate == 3.13  # 3.125


def test_volume(spark):
    df = orders(
        spark,
        {**at(1, 8), "order_id": "a", "total_amount": "10.10"},
        {**at(1, 8), "order_id": "b", "total_amount": "10.15", "merchant_id": "m2"},
        {**at(1, 23), "order_id": "c", "total_amount": "0.10", "customer_id": "c2"},
        {"event_timestamp": "no time", "order_id": "d"},
    )
    for report in (gold.order_volume(df), gold.order_volume_joined(df)):
        row = report.collect()
        assert len(row) == 1
        row = row[0]
        assert (row.total_orders, row.total_revenue, row.avg_order_value) == (3, 20.35, 6.78)
        assert (row.active_merchants, row.active_customers, row.active_hours) == (2, 2, 2)
        assert row.avg_orders_per_hour == 1.5


def test_fanout_weighs_orders_by_items(spark):
    feed = bronze(
        spark,
        {**at(1), "order_id": "a", "total_amount": "10", "items": [SOUP] * 3},
        {**at(1), "order_id": "b", "total_amount": "20", "items": []},
    )
    df, items = silver.silver_orders(feed), silver.order_items(feed)
    row = gold.order_volume_per_item(df, items.select("order_id", "item_id")).first()
    assert (row.total_orders, row.total_revenue, row.avg_order_value) == (2, 50.0, 12.5)
    joined = gold.orders_with_items(df, items.select("order_id", "item_id"))
    assert joined.agg(F.sum("total_amount")).first()[0] == 50.0 and joined.count() == 4


def test_one_pass_equals_single_reports(spark):
    df = orders(
        spark, at(1, eta=50), {**at(1), "order_status": "cancelled"}, {**at(2), "order_status": "created"}, at(3),
        {"event_timestamp": "no time"},
    )
    split = gold.split_daily(gold.daily_metrics(df))
    for name, report in {
        "fulfillment_metrics": gold.fulfillment,
        "delivery_time_metrics": gold.delivery_time,
        "order_volume_metrics": gold.order_volume,
        "eta_accuracy_metrics": gold.eta_accuracy,
    }.items():
        alone = report(df)
        assert split[name].columns == alone.columns
        assert sorted(map(str, split[name].collect())) == sorted(map(str, alone.collect()))


def test_top_days_breaks_ties(spark):
    volume = spark.createDataFrame(
        [("2025-02-03", 2, 5.0), ("2025-02-01", 2, 5.0), ("2025-02-02", 2, 9.0), ("2025-02-04", 1, 99.0)],
        "event_date string, total_orders long, total_revenue double",
    )
    assert [r.event_date[-1] for r in gold.top_days(volume, 3).collect()] == ["2", "1", "3"]


@pytest.mark.parametrize("amount", ["0.005", "1e3"])
def test_odd_amounts(spark, amount):
    row = gold.order_volume(orders(spark, {"total_amount": amount})).first()
    assert row.total_orders == 1

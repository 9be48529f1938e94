"""The whole run: stream landing, silver, warehouse, gold; repeated, late and failing."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dispatchlake.operators import gold, quality, sinks
from dispatchlake.plans import daily
from dispatchlake.schemas import FEED_RECORD
from dispatchlake.session import scratch, settle, shared_dir
from dispatchlake.sources import driver_tables as given
from dispatchlake.sources import feeds
from dispatchlake.streaming import jobs


def rows_of(df):
    return sorted(map(str, df.collect()))


def forget(spark):
    """Empty the catalog; files stay."""
    for name in ("orders", "order_items", *daily.GOLD):
        spark.sql(f"DROP VIEW IF EXISTS {name}")


@pytest.fixture()
def lake(spark, folder):
    yield daily.Lake(folder("lake"))
    forget(spark)


def message(order_id, at="2025-02-10 10:00:00.000000", **changes):
    item = {"item_id": "i1", "name": "n", "quantity": 2.0, "unit_price": "5.0", "total_price": "10.0"}
    return {
        "event_id": f"e{order_id}", "event_timestamp": at, "order_id": order_id, "merchant_id": "m", "customer_id": "c",
        "service_type": "groceries", "order_status": "delivered", "items": [item, item],
        "delivery_location": {"latitude": 1.0, "longitude": 2.0, "address": "x"}, "delivery_fee": "1000.00",
        "total_amount": "20.0", "estimated_delivery_time": at.replace("10:00", "10:50"), "payment_method": "card",
        "payment_status": "pending", **changes,
    }


def land(spark, folder, lake, landed, *values):
    rows = [("orders-raw", "k", v if isinstance(v, str) else json.dumps(v), i, landed) for i, v in enumerate(values)]
    spark.createDataFrame(rows, FEED_RECORD).write.mode("append").parquet(folder("in"))
    jobs.land_bronze(
        feeds.read_landing(spark, folder("in")), lake.bronze, folder("mark"), clock=F.col("timestamp")
    ).awaitTermination()


def test_run_repeat_late_and_update(spark, folder, lake):
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1"), message("2", order_status="created"), "{torn",
         message("3", total_amount="0"))
    assert daily.run(spark, lake, "v1") == [date(2025, 2, 10)]
    assert spark.table("orders").count() == 2
    assert spark.table("order_items").count() == 2  # the repeated item is one warehouse row
    assert daily.silver_items_table(spark, lake).count() == 4
    first = rows_of(spark.table("fulfillment_metrics"))
    assert spark.table("fulfillment_metrics").first().fulfillment_rate == 50.0
    assert daily.run(spark, lake, "v2") == []  # nothing pending, nothing changed
    assert rows_of(spark.table("fulfillment_metrics")) == first

    forget(spark)  # a new session with an empty catalog finds the current version by the ledger

    # next day: order 2 is delivered, and order 4 arrives late for the day before
    land(spark, folder, lake, datetime(2025, 2, 11, 9),
         message("2", at="2025-02-11 10:00:00.000000", event_id="e9"), message("4"))
    assert daily.run(spark, lake, "v2") == [date(2025, 2, 11)]
    got = {str(r.event_date): (r.total_orders, r.delivered_orders) for r in spark.table("fulfillment_metrics").collect()}
    assert got == {"2025-02-10": (2, 2), "2025-02-11": (1, 1)}
    assert daily.silver_orders_table(spark, lake).filter(F.col("event_date") == "2025-02-10").count() == 3


def test_a_repeated_silver_refresh_changes_nothing(spark, folder, lake):
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1"), message("2"))
    for _ in range(2):
        daily.refresh_silver(spark, lake, [date(2025, 2, 10)])
    assert daily.silver_orders_table(spark, lake).count() == 2


def test_a_first_day_without_valid_orders(spark, folder, lake):
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1", total_amount="0"), "{torn")
    assert daily.run(spark, lake, "v1") == [date(2025, 2, 10)]
    assert spark.table("orders").count() == 0 and spark.table("fulfillment_metrics").count() == 0
    land(spark, folder, lake, datetime(2025, 2, 11, 11), message("1"))
    assert daily.run(spark, lake, "v2") == [date(2025, 2, 11)]
    assert spark.table("orders").count() == 1


def test_the_filling_day_waits(spark, folder, lake):
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1"))
    assert daily.run(spark, lake, "v1", before=date(2025, 2, 10)) == []
    assert daily.run(spark, lake, "v1", before=date(2025, 2, 11)) == [date(2025, 2, 10)]


def test_a_failed_gate_leaves_the_day_pending(spark, folder, lake):
    bad = message("1")
    bad["items"] = [{**bad["items"][0], "quantity": 0.0}]
    land(spark, folder, lake, datetime(2025, 2, 10, 11), bad)
    with pytest.raises(quality.QualityGateError, match="quantity <= 0"):
        daily.run(spark, lake, "v1")
    assert daily.pending_ingest_days(spark, lake, date(2025, 3, 1)) == [date(2025, 2, 10)]
    assert daily.current_version(spark, lake) is None and not spark.catalog.tableExists("orders")


def test_bad_items_are_set_aside_and_later_days_go_on(spark, folder, lake):
    bad = message("1")
    bad["items"] = [*bad["items"] * 10, {**bad["items"][0], "item_id": "zero", "quantity": 0.0}]
    land(spark, folder, lake, datetime(2025, 2, 10, 11), bad, message("7", items=None))
    assert daily.run(spark, lake, "v1") == [date(2025, 2, 10)]
    assert daily.silver_items_table(spark, lake).count() == 20
    (reject,) = daily.item_rejects_table(spark, lake).collect()
    assert (reject.order_id, reject.item_id, reject.quantity, reject.reason) == ("1", "zero", 0, "quantity <= 0")
    report = {r.check: (r.failed, r.passed) for r in daily.check_silver(spark, lake, [date(2025, 2, 10)]).collect()}
    assert report["quantity <= 0"] == (1, True) and report["rows lost"] == (0, True)
    assert spark.table("order_items").count() == 1 and spark.table("orders").count() == 2
    land(spark, folder, lake, datetime(2025, 2, 11, 11), message("2"))
    assert daily.run(spark, lake, "v2") == [date(2025, 2, 11)]


def test_lost_items_fail_the_gate(spark, folder, lake):
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1"), message("2"))
    day = [date(2025, 2, 10)]
    daily.refresh_silver(spark, lake, day)
    sinks.write_days(daily.silver_items_table(spark, lake).filter("order_id = '1'"), lake.silver_items + "-cut", "event_date", "ingest_date")
    cut = daily.Lake(lake.root)
    report = quality.quarantine_report(
        "items", daily.silver_orders_table(spark, cut).select(F.size("items")),
        spark.read.parquet(lake.silver_items + "-cut"), daily.item_rejects_table(spark, cut), quality.item_checks(), 0.1,
    )
    with pytest.raises(quality.QualityGateError, match="rows lost on 2 rows"):
        quality.enforce(report)
    quality.enforce(daily.check_silver(spark, lake, day))


def test_a_repeated_day_leaves_nothing_behind(spark, folder, lake):
    """Run again after its records changed, an ingest day empties the event days it no longer brings."""
    day = [date(2025, 2, 10)]
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1"), message("2", at="2025-02-09 10:00:00.000000"),
         message("3", at="never"), message("4", total_amount="0"))
    land(spark, folder, lake, datetime(2025, 2, 11, 11), message("9", at="2025-02-09 10:00:00.000000"))
    daily.refresh_silver(spark, lake, [*day, date(2025, 2, 11)])
    assert daily.silver_orders_table(spark, lake).count() == 4
    landed = spark.read.parquet(lake.bronze).filter(F.get_json_object("value", "$.order_id").isin("1", "9"))
    other = daily.Lake(folder("other"))
    landed.write.partitionBy("topic", "ingest_date").parquet(other.bronze)
    moved = daily.Lake(lake.root)
    moved.__class__ = type("Moved", (daily.Lake,), {"bronze": property(lambda _: other.bronze)})
    for _ in range(2):
        daily.refresh_silver(spark, moved, day)
        kept = {r.order_id: str(r.event_date) for r in daily.silver_orders_table(spark, lake).collect()}
        assert kept == {"1": "2025-02-10", "9": "2025-02-09"}
        assert {r.order_id for r in daily.silver_items_table(spark, lake).collect()} == {"1", "9"}
        assert spark.read.parquet(lake.rejects).count() == 0


def test_rejects_are_replayed_under_a_new_check(spark, folder, lake, monkeypatch):
    bad = message("1")
    bad["items"] = [*bad["items"] * 10, {**bad["items"][0], "item_id": "zero", "quantity": 0.0}]
    land(spark, folder, lake, datetime(2025, 2, 10, 11), bad)
    daily.run(spark, lake, "v1")
    assert spark.table("order_items").count() == 1
    with monkeypatch.context() as newer:
        newer.setattr(quality, "item_checks", lambda: {"quantity < 0": F.col("quantity") < 0})
        for version in ("v2", "v3"):
            assert daily.run(spark, lake, version, again=[date(2025, 2, 10)]) == [date(2025, 2, 10)]
            assert daily.item_rejects_table(spark, lake).count() == 0
            assert {r.item_id for r in spark.table("order_items").collect()} == {"i1", "zero"}
            assert spark.table("fulfillment_metrics").first().total_orders == 1
    assert daily.pending_ingest_days(spark, lake, date(2025, 3, 1)) == []


def test_a_run_that_dies_late_is_repeated(spark, folder, lake, monkeypatch):
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1"), message("2"))
    assert daily.run(spark, lake, "v1") == [date(2025, 2, 10)]
    land(spark, folder, lake, datetime(2025, 2, 11, 11), message("3"))
    with monkeypatch.context() as broken:
        broken.setattr(daily, "refresh_gold", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily.run(spark, lake, "v2")
    assert daily.current_version(spark, lake) == "v1" and spark.table("orders").count() == 2
    assert daily.run(spark, lake, "v3") == [date(2025, 2, 11)]
    assert daily.current_table(spark, lake, "orders").count() == 3
    assert spark.table("fulfillment_metrics").first().total_orders == 3


def test_run_on_given_tables_equals_direct_reports(spark, folder, lake, sf_dir):
    records = given.feed_records(given.table(spark, sf_dir, "events"))
    records.write.parquet(folder("in"))
    jobs.land_bronze(
        feeds.read_landing(spark, folder("in")), lake.bronze, folder("mark"), clock=F.col("timestamp")
    ).awaitTermination()
    assert daily.run(spark, lake, "v1") == [date(2024, 2, 1)]
    orders = spark.table("orders")
    assert orders.count() == records.filter(F.col("topic") == "orders-raw").count()
    assert rows_of(spark.table("order_volume_metrics")) == rows_of(gold.order_volume(orders))


def test_a_merge_rewrites_touched_days_only(spark, folder, lake):
    day = "2025-02-{} 10:00:00.000000"
    land(spark, folder, lake, datetime(2025, 2, 12, 11), *[message(str(i), at=day.format(10 + i % 2)) for i in range(4)],
         message("9", at=day.format(13)), message("8", at="soon"))
    daily.run(spark, lake, "v1")
    orders = lake.warehouse["orders"]
    assert orders.live(spark, "v1") == {d: "v1" for d in ("2025-02-10", "2025-02-11", "2025-02-13", "none")}
    # order 9 moves to the 10th, which leaves the 13th empty; the 11th and the rows without a day are not touched
    land(spark, folder, lake, datetime(2025, 2, 14, 11), message("9", at=day.format(10), event_id="z"))
    daily.run(spark, lake, "v2")
    assert orders.live(spark, "v2") == {"2025-02-10": "v2", "2025-02-11": "v1", "none": "v1"}
    got = {r.order_id: str(r.event_date) for r in daily.current_table(spark, lake, "orders").collect()}
    assert got == {"0": "2025-02-10", "1": "2025-02-11", "2": "2025-02-10", "3": "2025-02-11", "9": "2025-02-10",
                   "8": "None"}
    assert rows_of(spark.table("orders")) == rows_of(daily.current_table(spark, lake, "orders"))
    totals = {str(r.event_date): r.total_orders for r in spark.table("fulfillment_metrics").collect()}
    assert totals == {"2025-02-10": 3, "2025-02-11": 2, "None": 1}
    assert rows_of(spark.table("daily_metrics")) == rows_of(gold.daily_metrics(spark.table("orders")))
    assert orders.read(spark, "v1").filter("order_id = '9'").first().day == "2025-02-13"  # v1 can still be read
    assert all("day=2025-02-10/version=v2" in f for f in orders.read(spark, "v2", ["2025-02-10"]).inputFiles())
    with pytest.raises(ValueError, match="used before"):
        orders.merge(spark, daily.silver_orders_table(spark, lake), "v2", "v2")


def test_days_are_replaced_not_added(spark, folder):
    df = spark.sql("select 1 v, date'2025-02-10' event_date union all select 2, date'2025-02-11' union all select 3, null")
    sinks.write_days(df, folder("t"))
    sinks.write_days(df.filter("v = 2").withColumn("v", F.lit(9)), folder("t"))
    assert sorted(r.v for r in spark.read.parquet(folder("t")).collect()) == [1, 3, 9]


def test_merchants_csv(spark, folder):
    df = spark.createDataFrame([('A "quoted" name', "Address: 1, Main St"), ("B", "Plain")], "Name string, Address string")
    sinks.write_csv(df, folder("raw"))
    sinks.write_csv(sinks.clean_merchants(sinks.read_merchants(spark, folder("raw"))), folder("clean"))
    got = {r.Name: r.Address for r in sinks.read_merchants(spark, folder("clean")).collect()}
    assert got == {'A "quoted" name': "1, Main St", "B": "Plain"}


def test_external_table_read_needs_only_options(spark, folder):
    spark.range(3).write.parquet(folder("t"))
    spark.read.parquet(folder("t")).createOrReplaceTempView("some_view")
    assert feeds.read_table(spark, "some_view").count() == 3


def test_shared_folder(spark):
    root = shared_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(root) and scratch(spark, "x") != scratch(spark, "x")
    assert settle(spark.range(3).toDF("id"), "x").count() == 3


def test_a_record_of_a_finished_day_is_in_the_next_run(spark, folder, lake):
    """Landing follows the clock of the batch, so a late record lands in a day that is still open."""
    stamped = datetime(2025, 2, 10, 23, 59)
    for order in ("1", "2"):
        rows = [("orders-raw", "k", json.dumps(message(order)), int(order), stamped)]
        spark.createDataFrame(rows, FEED_RECORD).write.mode("append").parquet(folder("in"))
        jobs.land_bronze(feeds.read_landing(spark, folder("in")), lake.bronze, folder("mark")).awaitTermination()
        landed = spark.read.parquet(lake.bronze).agg(F.max("ingest_date"), F.min("ingest_date")).first()
        assert landed[0] == landed[1] != stamped.date()
    assert len(daily.run(spark, lake, "v1", before=date(2999, 1, 1))) == 1
    assert spark.table("orders").count() == 2


def test_rejects_are_kept_with_their_reason(spark, folder, lake):
    land(spark, folder, lake, datetime(2025, 2, 10, 11), message("1"), "{torn", message("3", total_amount="0"),
         message(None), message("5", merchant_id=None))
    daily.run(spark, lake, "v1")
    rejects = {r.offset: r for r in spark.read.parquet(lake.rejects).collect()}
    assert {o: r.reason for o, r in rejects.items()} == {
        1: "malformed json", 2: "total_amount is no positive number", 3: "order_id is null", 4: "merchant_id is null"
    }
    assert rejects[1].value == "{torn" and rejects[1].key == "k"
    assert spark.table("orders").count() + len(rejects) == 5

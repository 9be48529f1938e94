import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from dispatchlake.operators import days, keyed, sinks


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """Events of which one key holds most, with many equal times."""
    rng = random.Random(7)
    start = datetime(2025, 1, 1)
    rows = [
        ("hot" if rng.random() < 0.7 else f"k{rng.randrange(20)}", start + timedelta(seconds=rng.randrange(50)), i)
        for i in range(4000)
    ]
    return rows, spark.createDataFrame(rows, "key string, at timestamp, id long").repartition(8)


def test_timeline_equals_brute_force(spark, hot):
    rows, df = hot
    ranks, expected = {}, []
    for key, at, i in sorted(rows, key=lambda r: (r[0], r[1], r[2]), reverse=True):
        ranks[key] = ranks.get(key, 0) + 1
        expected.append((key, at, i, ranks[key]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several cuts inside the hot key
    try:
        got = keyed.timeline(df, "key", ["at", "id"])
        assert as_set(got) == sorted(expected, key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_timeline_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "key string, id long")
    assert as_set(keyed.timeline(df, "key", ["id"])) == [("a", 1, 1), (None, 1, 2), (None, 2, 1)]


def test_latest_per_key(spark, hot):
    rows, df = hot
    best = {}
    for r in rows:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda x: (x[1], x[2]))
    assert as_set(keyed.latest_per_key(df, ["key"], ["at", "id"])) == sorted(best.values(), key=str)


def test_equal_times_fall_to_the_higher_offset(spark):
    df = spark.createDataFrame([("a", 1, 10, "x"), ("a", 1, 11, "y")], "key string, at int, offset int, v string")
    assert keyed.latest_per_key(df, ["key"], ["at", "offset"]).first().v == "y"


def test_replays_are_dropped(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "event_id int, v string")
    assert as_set(keyed.drop_replays(keyed.append(df, df, df), ["event_id"])) == [(1, "a"), (2, "b")]


ORDERS = "order_id string, total_amount double, order_status string"


def test_merge_updates_and_inserts(spark):
    target = spark.createDataFrame([("1", 10.0, "created"), ("2", 20.0, "created"), (None, 1.0, "x")], ORDERS)
    source = spark.createDataFrame([("2", 25.0, None), ("3", 30.0, "new"), (None, 2.0, "y")], ORDERS)
    assert as_set(keyed.merge_upsert(target, source)) == sorted(
        [("1", 10.0, "created"), ("2", 25.0, None), ("3", 30.0, "new"), (None, 1.0, "x"), (None, 2.0, "y")], key=str
    )


def test_merge_is_idempotent_and_picks_one_source_row(spark):
    target = spark.createDataFrame([("1", 10.0, "created")], ORDERS)
    source = spark.createDataFrame([("1", 11.0, "b"), ("1", 12.0, "a"), ("2", 1.0, "z"), ("2", 1.0, "z")], ORDERS)
    once = keyed.merge_upsert(target, source)
    assert as_set(once) == [("1", 12.0, "a"), ("2", 1.0, "z")]
    assert as_set(keyed.merge_upsert(once, source)) == as_set(once)
    newest = keyed.merge_upsert(target, source, newest_by=["order_status"])
    assert as_set(newest) == [("1", 11.0, "b"), ("2", 1.0, "z")]


def test_merge_keeps_repeated_target_rows(spark):
    target = spark.createDataFrame([("1", 10.0, "a"), ("1", 11.0, "b")], ORDERS)
    source = spark.createDataFrame([("1", 5.0, "c")], ORDERS)
    assert as_set(keyed.merge_upsert(target, source)) == [("1", 5.0, "c"), ("1", 5.0, "c")]


def test_merge_items_on_both_keys(spark):
    schema = "order_id string, item_id string, quantity int"
    target = spark.createDataFrame([("1", "a", 1), ("1", "b", 1)], schema)
    source = spark.createDataFrame([("1", "b", 9), ("2", "a", 3)], schema)
    assert as_set(keyed.merge_upsert(target, source)) == [("1", "a", 1), ("1", "b", 9), ("2", "a", 3)]


def test_merge_broadcasts_a_small_source(spark, folder):
    spark.range(200_000).selectExpr("cast(id as string) order_id", "id total_amount").write.parquet(folder("t"))
    target = spark.read.parquet(folder("t"))
    source = spark.range(5).selectExpr("cast(id as string) order_id", "-id total_amount")
    plan = keyed.merge_upsert(target, source)
    assert plan.count() == 200_000
    assert plan._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") >= 2


def test_table_merge_is_refused_by_parquet(spark, folder):
    spark.range(3).selectExpr("cast(id as string) order_id", "id v").write.option("path", folder("m")).saveAsTable("plain")
    source = spark.createDataFrame([("1", 5)], "order_id string, v long")
    with pytest.raises(UnsupportedOperationException, match="MERGE"):
        keyed.merge_into_table(source, "plain", ["order_id"], ["v"])
    spark.sql("DROP TABLE plain")


def test_align(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert keyed.align(df, ["C", "A"]).columns == ["c", "a"]


def test_lookup_reaches_the_scan(spark, folder):
    spark.createDataFrame([("a", 1), ("b", 2)], "order_id string, v int").write.parquet(folder("o"))
    found = keyed.point_lookup(spark.read.parquet(folder("o")), "order_id", "b")
    assert found.first().v == 2
    assert "EqualTo(order_id,b)" in found._jdf.queryExecution().executedPlan().toString()


def test_days(spark):
    bounds = spark.sql("select date'2025-02-27' first, date'2025-03-02' last")
    spine = days.date_spine(bounds)
    assert [r.folder for r in spine.orderBy("day").collect()] == [
        "2025/02/27",
        "2025/02/28",
        "2025/03/01",
        "2025/03/02",
    ]
    rows = spark.sql("select date'2025-02-28' event_date union all select null")
    assert {r.day.day: r.is_empty for r in days.empty_days(spine, rows).collect()} == {27: True, 28: False, 1: True, 2: True}
    left = days.pending_days(spine.select("day"), days.present_days(rows))
    assert left.filter(F.col("day") == "2025-02-28").count() == 0 and left.count() == 3


def test_merge_reads_each_side_once_and_spreads_null_keys(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed.merge_staged, "__defaults__", (True, 0))
    target = spark.createDataFrame([(f"{i}", i) for i in range(50)] + [(None, i) for i in range(40)], "order_id string, v int")
    source = spark.createDataFrame([(f"{i}", -i) for i in range(40, 60)] + [("41", -99), (None, 7)], "order_id string, v int")
    target.write.parquet(folder("t"))
    source.write.parquet(folder("s"))
    merged = keyed.merge_upsert(spark.read.parquet(folder("t")), spark.read.parquet(folder("s")), ["order_id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("FullOuter") == 1
    got = sorted(((r.order_id, r.v) for r in merged.collect()), key=str)
    want = [(f"{i}", i) for i in range(40)] + [(f"{i}", -i) for i in range(40, 60)] + [(None, i) for i in range(40)] + [(None, 7)]
    assert got == sorted(want, key=str)


def test_bucketed_target_is_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(keyed.merge_staged, "__defaults__", (True, 0))
    rows = spark.range(2000).selectExpr("cast(id as string) order_id", "id v")
    sinks.write_buckets(rows, "bucketed_target", ["order_id"], 16)
    source = spark.range(1990, 2010).selectExpr("cast(id as string) order_id", "-id v")
    merged = keyed.merge_upsert(spark.table("bucketed_target"), source, ["order_id"], spread_nulls=False)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("FileScan") == 1
    join = plan.index("FullOuter")
    assert "Exchange" not in plan[join : plan.index("FileScan")]  # the target is the first child
    assert merged.count() == 2010 and merged.filter("v < 0").count() == 20
    assert keyed.point_lookup(spark.table("bucketed_target"), "order_id", "77").count() == 1

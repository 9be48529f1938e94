"""Typed landing: a schema that grows, and values that do not fit."""

import json

from pyspark.sql import types as T

from dispatchlake.schemas import FEED_RECORD
from dispatchlake.sources import feeds
from dispatchlake.streaming import typed

CONTRACT = T.StructType().add("event_id", "string").add("amount", "double").add("place", T.StructType().add("lat", "double"))


def land(spark, folder, *values):
    rows = [("orders-raw", "k", v if isinstance(v, str) else json.dumps(v), i, None) for i, v in enumerate(values)]
    spark.createDataFrame(rows, FEED_RECORD).coalesce(1).write.mode("append").parquet(folder("landing"))
    source = feeds.read_landing(spark, folder("landing"))
    typed.land_typed(source, folder("typed"), folder("mark"), CONTRACT).awaitTermination()
    return typed.read_typed(spark, folder("typed"), CONTRACT)


def test_schema_grows_and_nothing_is_lost(spark, folder):
    land(spark, folder, {"event_id": "1", "amount": 2, "place": {"lat": 1.5}}, {"event_id": "2", "amount": None})
    second = {"event_id": "3", "amount": "ten", "place": {"lat": 2.0, "floor": 4}, "tip": 3, "tags": ["a"]}
    land(spark, folder, second, "{torn", "[1]", {"event_id": 5, "place": "here"})
    df = land(spark, folder, {"event_id": "6", "tip": 2.5, "amount": 7.25}, {"event_id": "7", "tip": 9, "tags": []})
    assert dict(df.dtypes)["place"] == "struct<lat:double,floor:bigint>" and dict(df.dtypes)["tip"] == "bigint"
    rows = {r.event_id: r for r in df.collect() if r.event_id}
    assert rows["1"].amount == 2.0 and rows["1"].place == (1.5, None) and rows["1"].rescued == {}
    assert rows["2"].amount is None and rows["2"].rescued == {}
    assert rows["3"].rescued == {"amount": '"ten"'} and rows["3"].place == (2.0, 4) and rows["3"].tags == ["a"]
    assert rows["6"].rescued == {"tip": "2.5"} and rows["6"].amount == 7.25
    assert rows["7"].tip == 9 and rows["7"].tags == []
    others = sorted(str(sorted(r.rescued.items())) for r in df.collect() if not r.event_id)
    assert others == sorted(["[('value', '{torn')]", "[('value', '[1]')]", "[('event_id', '5'), ('place', '\"here\"')]"])


def test_readers_take_only_their_columns(spark, folder):
    df = land(spark, folder, {"event_id": "1", "amount": 2, "place": {"lat": 1.5}})
    plan = df.select("amount")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<amount:double>" in plan

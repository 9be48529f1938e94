"""Typed landing: records as columns, under a schema that grows with what is sent.

The fields of a feed's contract have the contract's types. Fields beyond it get the type that a batch shows, by
one aggregate over the batch; the result is merged into the stored schema, which only ever grows: a type once
given stays. A value that its column cannot hold, because it came with another type, is kept as sent in
the map ``rescued`` under its field's name, so no batch loses anything; neither does an unreadable value, which is
``rescued`` whole under the name ``value``.

A batch writes its schema first and its data, in a folder of its own, second: run again, it replaces both.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dispatchlake.operators.daytable import read_stored
from dispatchlake.operators.inference import plain_type

ENVELOPE = ["topic", "key", "offset", "partition", "timestamp"]
RESCUED = "rescued"
SCHEMAS = "batch long, schema string"


def merged(stored: T.DataType, sent: T.DataType) -> T.DataType:
    """The stored type, with the fields that only the sent one has, at any depth."""
    if isinstance(stored, T.StructType) and isinstance(sent, T.StructType):
        known = {f.name: f.dataType for f in stored}
        both = [T.StructField(n, merged(t, sent[n].dataType) if n in sent.names else t) for n, t in known.items()]
        return T.StructType(both + [T.StructField(f.name, f.dataType) for f in sent if f.name not in known])
    if isinstance(stored, T.ArrayType) and isinstance(sent, T.ArrayType):
        return T.ArrayType(merged(stored.elementType, sent.elementType))
    return stored


def stored_schema(spark: SparkSession, root: str, contract: T.StructType, before: int | None = None) -> T.StructType:
    """The columns of the landed messages: of all batches, or of those before a given one."""
    versions = read_stored(spark, T.StructType.fromDDL(SCHEMAS), f"{root}/schemas")
    if before is not None:
        versions = versions.filter(F.col("batch") < before)
    last = versions.orderBy(F.desc("batch")).select("schema").first()
    return T.StructType.fromJson(json.loads(last["schema"])) if last else contract


def sent_schema(batch: DataFrame, stored: T.StructType) -> tuple[T.StructType, set[str]]:
    """The shape of a batch's messages, and its nested fields whose parts came with several types.

    One aggregate. A stored nested field is looked at by itself, over values of its kind, so that one value
    of another kind does not hide what the others hold.
    """
    nested = {f.name: f for f in stored if isinstance(f.dataType, (T.StructType, T.ArrayType))}
    parsed = batch.select(F.try_parse_json("value").alias("_v")).filter(F.schema_of_variant("_v").startswith("OBJECT"))
    own = []
    for name, field in nested.items():
        sent = _sent(name)
        own.append(F.schema_of_variant_agg(F.when(_same_kind(sent, field), sent)).alias(f"of_{name}"))
    shapes = parsed.agg(F.schema_of_variant_agg("_v").alias("whole"), *own).first()
    whole = _type_of(shapes["whole"])
    fields = {f.name: f.dataType for f in whole} if isinstance(whole, T.StructType) else {}
    unsure = set()
    for name in nested:
        shape = shapes[f"of_{name}"] or "VOID"
        if shape != "VOID":
            fields[name] = _type_of(shape)
        if "VARIANT" in shape:
            unsure.add(name)
    return T.StructType([T.StructField(n, t) for n, t in fields.items()]), unsure


def _type_of(shape: str | None) -> T.DataType:
    return T.DataType.fromDDL(plain_type(shape)) if shape else T.StructType()


def _sent(name: str) -> Column:
    return F.try_variant_get("_v", f"$.{name}", "variant")


def _same_kind(variant: Column, field: T.StructField) -> Column:
    return F.schema_of_variant(variant).startswith("OBJECT" if isinstance(field.dataType, T.StructType) else "ARRAY")


def _fits(variant: Column, field: T.StructField) -> Column:
    """Whether a column of the field's type can hold a value: the cast works, and cuts no fraction off."""
    kind = F.schema_of_variant(variant)
    fits = F.try_variant_get(variant, "$", field.dataType.simpleString()).isNotNull()
    if isinstance(field.dataType, (T.StructType, T.ArrayType)):
        return fits & _same_kind(variant, field)
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        return fits & (kind == "BIGINT")
    if isinstance(field.dataType, T.BooleanType):
        return fits & (kind == "BOOLEAN")
    if isinstance(field.dataType, T.DoubleType):
        return fits & (kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE"))
    return fits & (kind == "STRING")


def typed(records: DataFrame, schema: T.StructType, unsure: set[str] = frozenset()) -> DataFrame:
    """Records as the envelope, a column for each field, and what the columns cannot hold.

    Of fields in ``unsure`` every value is kept as sent, beside its column.
    """
    parsed = records.withColumn("_v", F.try_parse_json("value"))
    columns, misfits = [], []
    for field in schema:
        sent = _sent(field.name)
        given = sent.isNotNull() & ~F.is_variant_null(sent)
        fits = F.coalesce(_fits(sent, field), F.lit(False))
        value = F.try_variant_get("_v", f"$.{field.name}", field.dataType.simpleString())
        columns.append(F.when(given & fits, value).alias(field.name))
        kept = given if field.name in unsure else given & ~fits
        misfits.append(F.when(kept, F.struct(F.lit(field.name).alias("key"), F.to_json(sent).alias("value"))))
    whole = F.when(
        F.col("_v").isNull() | ~F.schema_of_variant("_v").startswith("OBJECT"),
        F.struct(F.lit("value").alias("key"), F.col("value").alias("value")),
    )
    rescued = F.map_from_entries(F.filter(F.array(whole, *misfits), lambda m: m.isNotNull()))
    envelope = [F.col(c).alias(f"record_{c}") for c in ENVELOPE if c in records.columns]
    # one explode keeps later filters on the columns from parsing the text again
    row = F.struct(*envelope, *columns, rescued.alias(RESCUED))
    return parsed.select(F.explode(F.array(row)).alias("r")).select("r.*")


def land_typed(
    records: DataFrame, root: str, checkpoint: str, contract: T.StructType, trigger: dict | None = None, day: Column | None = None
) -> StreamingQuery:
    """One feed's records as typed columns below ``root``, by the day of landing (``day`` replaces the clock's)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            stored = stored_schema(spark, root, contract, batch_id)
            sent, unsure = sent_schema(batch, stored)
            schema = merged(stored, sent)
            version = spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1)
            version.write.mode("overwrite").parquet(f"{root}/schemas/batch={batch_id}")
            dated = typed(batch, schema, unsure).withColumn("ingest_date", F.to_date("record_timestamp") if day is None else day)
            dated.write.mode("overwrite").partitionBy("ingest_date").parquet(f"{root}/data/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_typed(spark: SparkSession, root: str, contract: T.StructType) -> DataFrame:
    """All landed rows under the newest schema; columns that a file does not have are null."""
    schema = stored_schema(spark, root, contract)
    envelope = T.StructType.fromDDL("record_topic string, record_key string, record_offset long, record_partition int, record_timestamp timestamp")
    more = T.StructType.fromDDL(f"{RESCUED} map<string,string>, ingest_date date")
    return read_stored(spark, reduce(lambda a, b: T.StructType(a.fields + b.fields), (envelope, schema, more)), f"{root}/data")

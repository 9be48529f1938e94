"""Schema of JSON text, merged over all rows in one distributed aggregate."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_shape(records: DataFrame, value: str = "value") -> DataFrame:
    """One row with the merged shape of all readable values; malformed ones are skipped."""
    return records.agg(F.schema_of_variant_agg(F.try_parse_json(value)).alias("shape"))


def plain_shape(records: DataFrame, value: str = "value") -> DataFrame:
    """:func:`json_shape` with fractional numbers as doubles and never-filled values as text."""
    doubles = F.regexp_replace("shape", r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE")
    return json_shape(records, value).select(F.regexp_replace(doubles, r"\b(VOID|VARIANT)\b", "STRING").alias("shape"))


def infer_schema(records: DataFrame, value: str = "value") -> str:
    """Schema string of the values for ``from_json``. Only the one-row shape reaches the driver."""
    return plain_shape(records, value).first()["shape"].replace("OBJECT<", "STRUCT<")


def plain_type(shape: str) -> str:
    """The shape of a value as a type, by the rules of :func:`plain_shape`."""
    doubles = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", shape)
    return re.sub(r"\b(VOID|VARIANT)\b", "STRING", doubles).replace("OBJECT<", "STRUCT<")

"""Vector columns: which take part, and a key that equal vectors share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: str) -> Column:
    """Neither null nor zero, and every component a finite number."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(v).isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def keyed(df: DataFrame, vector: str) -> DataFrame:
    """Adds ``v`` (doubles, one zero), and ``k1``, ``k2``: 128 bits that stand for the vector."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    return df.withColumn("v", v).withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(7), "v"))


def matrix(column) -> np.ndarray:
    """A list column of one length as rows of a double matrix."""
    return np.stack(column.to_numpy(zero_copy_only=False)) if len(column) else np.empty((0, 0))

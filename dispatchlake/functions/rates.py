"""Ratios rounded half up at two decimals, computed in decimals so that ties fall the same way everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_2dp(value: Column) -> Column:
    return F.round(value, 2).cast("double")


def mean_2dp(total: Column, n: Column) -> Column:
    """``total / n``; null for an empty group. ``total`` must be a decimal."""
    return round_2dp(F.try_divide(total, n.cast("decimal(18,0)")))


def percent_2dp(part: Column, whole: Column) -> Column:
    return mean_2dp(part.cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)"), whole)

"""Day lists: the calendar of a run, what is left to do, which days are empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day from ``first`` to ``last`` of a one-row frame, with its lake folder."""
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day")).select(
        "day", F.date_format("day", "yyyy/MM/dd").alias("folder")
    )


def present_days(rows: DataFrame, day: str = "event_date") -> DataFrame:
    return rows.select(F.col(day).alias("day")).filter(F.col("day").isNotNull()).distinct()


def pending_days(available: DataFrame, done: DataFrame) -> DataFrame:
    """Days that are available and not done."""
    return available.join(done, "day", "left_anti")


def empty_days(spine: DataFrame, rows: DataFrame, day: str = "event_date") -> DataFrame:
    """The spine with a flag for days that have no row. Only distinct days meet the join."""
    seen = present_days(rows, day).withColumn("seen", F.lit(True))
    return spine.join(seen, "day", "left").select("day", F.col("seen").isNull().alias("is_empty"))

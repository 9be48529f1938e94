"""Data quality: each layer is checked by one aggregate over the whole layer, reported as small rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.functions.parsing import money, to_double
from dispatchlake.schemas import DELAY_THRESHOLD_MINUTES


class QualityGateError(RuntimeError):
    """A layer failed one of its checks."""


def _long(df: DataFrame, counts: dict[str, Column], key: str, value: str) -> DataFrame:
    """One aggregate row turned into (key, value) rows."""
    wide = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts.values())])
    pairs = F.array(
        *[F.struct(F.lit(n).alias(key), F.col(f"c{i}").alias(value)) for i, n in enumerate(counts)]
    )
    return wide.select(F.explode(pairs).alias("p")).select(f"p.{key}", f"p.{value}")


def count_failures(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, failed): rows on which each condition holds, all in one pass."""
    return _long(df, {n: F.count_if(c) for n, c in checks.items()}, "check", "failed")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(check, failed): nulls per required column."""
    return count_failures(df, {f"{c} is null": F.col(c).isNull() for c in columns})


def amount_checks(bronze: DataFrame) -> DataFrame:
    """(check, failed): amounts that are not positive, or not numbers at all."""
    amount = to_double("total_amount")
    return count_failures(
        bronze,
        {
            "total_amount <= 0": amount <= 0,
            "total_amount not a number": F.col("total_amount").isNotNull() & amount.isNull(),
        },
    )


def time_checks(bronze: DataFrame, columns: list[str], parse) -> DataFrame:
    """(check, failed): texts that are no times."""
    return count_failures(
        bronze, {f"{c} unreadable": F.col(c).isNotNull() & parse(c).isNull() for c in columns}
    )


def breaks_delay_rule() -> Column:
    late = F.coalesce(F.col("delivery_time_minutes") > DELAY_THRESHOLD_MINUTES, F.lit(False))
    return ~F.col("is_delayed").eqNullSafe(late)


def wrong_item_totals(bronze: DataFrame) -> DataFrame:
    """Items whose stated total is not unit price times quantity, in exact money."""
    items = bronze.select("order_id", F.explode("items").alias("i"))
    stated, unit = money("i.total_price"), money("i.unit_price")
    expected = unit * F.col("i.quantity").cast("decimal(18,0)")
    return items.filter(stated != expected).select(
        "order_id",
        F.col("i.item_id").alias("item_id"),
        F.col("i.quantity").cast("bigint").alias("quantity"),
        unit.cast("double").alias("unit_price"),
        stated.cast("double").alias("total_price"),
    )


def wrong_order_totals(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Orders whose amount is not the sum of their items, in exact money; orders without items are left out.

    ``totals`` has (order_id, items_total) per message of an order; they are added up here.
    """
    summed = totals.groupBy("order_id").agg(F.sum("items_total").alias("items_total"))
    stated = orders.select("order_id", money("total_amount").alias("stated")).filter(F.col("stated").isNotNull())
    return stated.join(summed, "order_id").filter(F.col("stated") != F.col("items_total")).select(
        "order_id",
        F.col("stated").cast("double").alias("total_amount"),
        F.col("items_total").cast("double").alias("items_total"),
    )


def domain_counts(
    df: DataFrame, enums: dict[str, list[str]], ranges: dict[str, tuple[int, int]] | None = None
) -> DataFrame:
    """(field, value, rows, in_domain) of closed-domain columns. Optional (ranged) values may be null."""
    ranges = ranges or {}
    fields = [*enums, *ranges]
    long = df.select(*[F.col(f).cast("string").alias(f) for f in fields]).unpivot([], fields, "field", "value")
    allowed = F.coalesce(
        *[F.when(F.col("field") == f, F.coalesce(F.col("value").isin(v), F.lit(False))) for f, v in enums.items()],
        *[
            F.when(F.col("field") == f, F.coalesce(F.col("value").cast("int").between(*r), F.lit(True)))
            for f, r in ranges.items()
        ],
    )
    return long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("rows")).withColumn("in_domain", allowed)


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """(column, expected_type, actual_type, matches, rows, nulls) over expected and surplus columns."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = [*wanted, *[n for n in actual if n not in wanted]]
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count_if(F.col(n).isNull()).alias(f"c{i}") for i, n in enumerate(names) if n in actual]
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(wanted.get(n)).cast("string").alias("expected_type"),
            F.lit(actual.get(n)).cast("string").alias("actual_type"),
            F.lit(wanted.get(n) == actual.get(n)).alias("matches"),
            F.col("n").alias("rows"),
            (F.col(f"c{i}") if n in actual else F.lit(None).cast("bigint")).alias("nulls"),
        )
        for i, n in enumerate(names)
    ]
    return df.agg(*counts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missing_feeds(records: DataFrame, required: list[str], feed: str, at: str) -> DataFrame:
    """(hour, feed) pairs with no record, for every hour from the first to the last record.

    An hour in which nothing at all came is reported for every feed.
    """
    present = records.select(F.date_trunc("hour", at).alias("hour"), F.col(feed).alias("feed")).distinct()
    bounds = present.filter(F.col("hour").isNotNull()).agg(F.min("hour").alias("first"), F.max("hour").alias("last"))
    hours = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 hour"))).alias("hour"))
    wanted = hours.select("hour", F.explode(F.array(*map(F.lit, required))).alias("feed"))
    return wanted.join(present, ["hour", "feed"], "left_anti")


def freshness_and_volume(orders: DataFrame, minimum: int = 1) -> DataFrame:
    """Per day: orders, newest event, and whether the day reaches the minimum volume."""
    return orders.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("orders"),
        F.max("event_timestamp").alias("newest_event"),
        (F.count(F.lit(1)) >= minimum).alias("enough"),
    )


# Checks of each layer: a condition that must hold on no row.
def silver_checks() -> dict[str, Column]:
    return {
        "order_id is null": F.col("order_id").isNull(),
        "merchant_id is null": F.col("merchant_id").isNull(),
        "total_amount <= 0": F.col("total_amount") <= 0,
        "event_timestamp is null": F.col("event_timestamp").isNull(),
        "delay rule broken": breaks_delay_rule(),
    }


def item_checks() -> dict[str, Column]:
    return {
        "item_id is null": F.col("item_id").isNull(),
        "quantity <= 0": F.col("quantity") <= 0,
        "total_price <= 0": F.col("total_price") <= 0,
    }


def first_broken(checks: dict[str, Column]) -> Column:
    """The first check that a row breaks, or null."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in checks.items()])


def gold_checks() -> dict[str, Column]:
    return {
        "fulfillment_rate out of range": ~F.col("fulfillment_rate").between(0, 100),
        "more delivered than ordered": F.col("delivered_orders") > F.col("total_orders"),
        "event_date is null": F.col("event_date").isNull(),
    }


def gate_report(layers: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(layer, check, failed, passed): one aggregate per layer."""
    reports = [
        count_failures(df, checks).select(
            F.lit(name).alias("layer"), "check", "failed", (F.col("failed") == 0).alias("passed")
        )
        for name, (df, checks) in layers.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), reports)


def quarantine_report(
    layer: str, expected: DataFrame, kept: DataFrame, rejected: DataFrame, checks: dict[str, Column], share: float
) -> DataFrame:
    """(layer, check, failed, passed) of a layer whose bad rows were set aside with the check they broke as ``reason``.

    A check passes while it took no more than ``share`` of the rows; ``expected`` has one column with the rows to
    account for, and "rows lost" says how many are neither kept nor rejected (below zero: came twice). One aggregate.
    """
    rows = kept.select(F.lit(None).cast("string").alias("reason"), F.lit(-1).cast("bigint").alias("n"))
    rows = rows.unionByName(rejected.select("reason", F.lit(-1).cast("bigint").alias("n")))
    want = expected.select(F.lit(None).cast("string").alias("reason"), F.col(expected.columns[0]).cast("bigint").alias("n"))
    taken = [F.count_if(F.col("reason") == name).alias(f"c{i}") for i, name in enumerate(checks)]
    wide = rows.unionByName(want).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lost"), F.count_if(F.col("n") < 0).alias("rows"), *taken
    )
    lines = [(name, F.col(f"c{i}"), F.col(f"c{i}") <= F.col("rows") * share) for i, name in enumerate(checks)]
    lines.append(("rows lost", F.col("lost"), F.col("lost") == 0))
    report = [
        F.struct(F.lit(layer).alias("layer"), F.lit(name).alias("check"), n.alias("failed"), ok.alias("passed"))
        for name, n, ok in lines
    ]
    return wide.select(F.explode(F.array(*report)).alias("r")).select("r.*")


def enforce(report: DataFrame) -> None:
    """Stop the run if a check failed. The report has one row per check, so it may come to the driver."""
    broken = report.filter(~F.col("passed")).collect()
    if broken:
        raise QualityGateError("; ".join(f"{r.layer}: {r.check} on {r.failed} rows" for r in broken))

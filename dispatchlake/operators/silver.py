"""Bronze orders to typed order and item rows. Everything is narrow: no shuffle until the write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlake.functions.parsing import parse_time, to_double, to_float
from dispatchlake.schemas import DELAY_THRESHOLD_MINUTES


def valid_orders(bronze: DataFrame) -> DataFrame:
    """Orders with both identifiers and a positive, readable amount."""
    return bronze.filter(
        F.col("order_id").isNotNull()
        & F.col("merchant_id").isNotNull()
        & (to_double("total_amount") > 0)
    )


def reject_reason(prefix: str = "") -> Column:
    """Why :func:`valid_orders` leaves an order out: the first rule it breaks. Null for valid ones."""
    amount = to_double(F.col(f"{prefix}total_amount"))
    return (
        F.when(F.col(f"{prefix}order_id").isNull(), "order_id is null")
        .when(F.col(f"{prefix}merchant_id").isNull(), "merchant_id is null")
        .when(~F.coalesce(amount > 0, F.lit(False)), "total_amount is no positive number")
    )


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Typed valid orders with day, flat location, delivery minutes and the delay flag.

    ``items`` is carried along when the input has it. Unreadable times become null: such an order is
    kept, has no minutes and is not delayed.
    """
    typed = valid_orders(bronze).withColumns(
        {
            "event_timestamp": parse_time("event_timestamp"),
            "estimated_delivery_time": parse_time("estimated_delivery_time"),
            "delivery_fee": to_float("delivery_fee"),
            "total_amount": to_double("total_amount"),
        }
    )
    # Whole seconds on both sides first, then minutes rounded half up.
    seconds = F.unix_timestamp("estimated_delivery_time") - F.unix_timestamp("event_timestamp")
    minutes = F.round(seconds / 60)
    return typed.select(
        *[c for c in typed.columns if c != "delivery_location"],
        F.to_date("event_timestamp").alias("event_date"),
        F.col("delivery_location.latitude").alias("delivery_latitude"),
        F.col("delivery_location.longitude").alias("delivery_longitude"),
        minutes.alias("delivery_time_minutes"),
        F.coalesce(minutes > DELAY_THRESHOLD_MINUTES, F.lit(False)).alias("is_delayed"),
    )


def order_items(orders: DataFrame, keep_empty: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per item; orders with a null or empty list give none unless ``keep_empty``.

    Works on a list of structs as well as on a list of string maps. ``carry`` names further order columns
    to repeat on each item, such as the days the items table is stored by.
    """
    entries = (F.explode_outer if keep_empty else F.explode)("items")
    return orders.select("order_id", *carry, entries.alias("item")).select(
        "order_id",
        F.col("item.item_id").alias("item_id"),
        F.col("item.name").alias("name"),
        F.col("item.quantity").try_cast("int").alias("quantity"),
        to_double(F.col("item.unit_price")).alias("unit_price"),
        to_double(F.col("item.total_price")).alias("total_price"),
        *carry,
    )


def line_totals(items: DataFrame) -> DataFrame:
    """Unit price times quantity next to the total the message stated."""
    return items.withColumn("line_total", F.col("unit_price") * F.col("quantity"))


def order_totals(bronze: DataFrame) -> DataFrame:
    """Order total folded over its own item list, in exact money, without a shuffle."""
    total = F.aggregate(
        F.coalesce("items", F.array().cast(bronze.schema["items"].dataType)),
        F.lit(0).cast("decimal(28,2)"),
        lambda acc, item: (acc + F.coalesce(item.total_price.try_cast("decimal(27,2)"), F.lit(0))).cast(
            "decimal(28,2)"
        ),
    )
    return bronze.select("order_id", total.alias("items_total"))

"""Daily metrics over warehouse orders (one row per order id, which the merge guarantees).

Each metric is one partial + final aggregate on ``event_date``: map-side partials reduce a hot day before
the shuffle, and money stays decimal until the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlake.functions.parsing import money
from dispatchlake.functions.rates import mean_2dp, percent_2dp, round_2dp
from dispatchlake.schemas import PROMISED_MINUTES


def _is(status: str) -> Column:
    """Status comparison that ignores case: the wire is lower case, reports ask in upper case."""
    return F.upper("order_status") == status.upper()


def _minutes_mean(value: Column) -> Column:
    exact = value.cast("decimal(18,2)")
    return mean_2dp(F.sum(exact), F.count(exact))


def _fulfillment() -> dict[str, Column]:
    total = F.count("order_id")
    delivered = F.count_if(_is("delivered"))
    cancelled = F.count_if(_is("cancelled"))
    return {
        "total_orders": total,
        "delivered_orders": delivered,
        "fulfillment_rate": percent_2dp(delivered, total),
        "cancelled_orders": cancelled,
        "cancellation_rate": percent_2dp(cancelled, total),
        "delay_rate": percent_2dp(F.count_if("is_delayed"), F.count(F.lit(1))),
    }


def _delivery_time(among: Column) -> dict[str, Column]:
    minutes = F.col("delivery_time_minutes")
    return {
        "avg_delivery_time": _minutes_mean(F.when(among, minutes)),
        "avg_delayed_delivery_time": _minutes_mean(F.when(among & F.col("is_delayed"), minutes)),
        "avg_ontime_delivery_time": _minutes_mean(F.when(among & ~F.col("is_delayed"), minutes)),
    }


def _eta_accuracy(among: Column, promised_minutes: int) -> dict[str, Column]:
    deviation = F.abs(F.col("delivery_time_minutes") - promised_minutes)
    delayed = F.count_if(among & F.col("is_delayed"))
    return {
        "avg_eta_deviation": _minutes_mean(F.when(among, deviation)),
        "delayed_deliveries": delayed,
        "delay_rate": percent_2dp(delayed, F.count_if(among)),
    }


def _volume() -> dict[str, Column]:
    amount = money("total_amount")
    hour_bits = F.bit_or(F.expr("shiftleft(1, hour(event_timestamp))"))
    hours = F.coalesce(F.bit_count(hour_bits), F.lit(0)).cast("bigint")
    orders = F.count(F.lit(1))
    return {
        "total_orders": F.count("order_id"),
        "total_revenue": round_2dp(F.sum(amount)),
        "avg_order_value": mean_2dp(F.sum(amount), F.count(amount)),
        "active_merchants": F.count_distinct("merchant_id"),
        "active_customers": F.count_distinct("customer_id"),
        "active_hours": hours,
        "avg_orders_per_hour": mean_2dp(orders.cast("decimal(18,0)"), hours),
    }


def _daily(orders: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    return orders.groupBy("event_date").agg(*[c.alias(n) for n, c in metrics.items()])


def fulfillment(orders: DataFrame) -> DataFrame:
    """Orders, delivered, cancelled and delayed shares per day."""
    return _daily(orders, _fulfillment())


def delivery_time(orders: DataFrame) -> DataFrame:
    """Mean minutes of delivered orders per day: all, delayed, on time. Days without deliveries have no row."""
    return _daily(orders.filter(_is("delivered")), _delivery_time(F.lit(True)))


def eta_accuracy(orders: DataFrame, promised_minutes: int = PROMISED_MINUTES) -> DataFrame:
    """Mean distance of delivery minutes from the promise, and the delayed share, per day of deliveries."""
    return _daily(orders.filter(_is("delivered")), _eta_accuracy(F.lit(True), promised_minutes))


def order_volume(orders: DataFrame) -> DataFrame:
    """Volume, revenue, active parties and hourly spread per day in one aggregate.

    The hours of a day fit in one integer, so the hourly half needs neither its own scan nor a join:
    a bit per hour is or-ed and counted. Orders without a readable time belong to no day.
    """
    return _daily(orders.filter(F.col("event_date").isNotNull()), _volume())


def hourly_orders(orders: DataFrame) -> DataFrame:
    """Orders per day and hour."""
    return orders.groupBy("event_date", F.hour("event_timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def hourly_distribution(orders: DataFrame) -> DataFrame:
    """Active hours and mean orders per active hour, per day."""
    return (
        hourly_orders(orders)
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("active_hours"),
            mean_2dp(F.sum("orders").cast("decimal(18,0)"), F.count(F.lit(1))).alias("avg_orders_per_hour"),
        )
    )


def order_volume_joined(orders: DataFrame) -> DataFrame:
    """The same report as :func:`order_volume` put together from its two per-day halves with an inner join."""
    volume = {n: c for n, c in _volume().items() if n not in ("active_hours", "avg_orders_per_hour")}
    return _daily(orders, volume).join(hourly_distribution(orders), "event_date")


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Left join of orders to their items: one row per item, or one with null item columns."""
    return orders.join(items, "order_id", "left")


def order_volume_per_item(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Volume weighted by item rows, i.e. over the order-item join instead of over orders.

    Item rows are counted per order first, so the join stays one to one and nothing fans out; an
    order then weighs as many rows as the join would have given it.
    """
    weights = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("weight"))
    weighed = orders.join(weights, "order_id", "left").withColumn("weight", F.coalesce("weight", F.lit(1)))
    amount = money("total_amount")
    rows = F.sum(F.when(amount.isNotNull(), F.col("weight")))
    revenue = F.sum((amount * F.col("weight").cast("decimal(9,0)")).cast("decimal(28,2)"))
    volume = weighed.groupBy("event_date").agg(
        F.count("order_id").alias("total_orders"),
        round_2dp(revenue).alias("total_revenue"),
        mean_2dp(revenue, rows).alias("avg_order_value"),
        F.count_distinct("merchant_id").alias("active_merchants"),
        F.count_distinct("customer_id").alias("active_customers"),
    )
    return volume.join(hourly_distribution(orders), "event_date")


def daily_metrics(orders: DataFrame, promised_minutes: int = PROMISED_MINUTES) -> DataFrame:
    """All four reports in one pass over orders; :func:`split_daily` cuts it into the published tables."""
    delivered = _is("delivered")
    eta = _eta_accuracy(delivered, promised_minutes)
    volume = {n: c for n, c in _volume().items() if n != "total_orders"}
    return _daily(
        orders,
        {
            **_fulfillment(),
            **_delivery_time(delivered),
            **volume,
            "avg_eta_deviation": eta["avg_eta_deviation"],
            "delayed_deliveries": eta["delayed_deliveries"],
            "delivered_delay_rate": eta["delay_rate"],
        },
    )


def split_daily(daily: DataFrame) -> dict[str, DataFrame]:
    """The published tables out of :func:`daily_metrics`, with the rows each report has on its own."""
    with_deliveries = daily.filter(F.col("delivered_orders") > 0)
    return {
        "fulfillment_metrics": daily.select("event_date", *_fulfillment()),
        "delivery_time_metrics": with_deliveries.select("event_date", *_delivery_time(F.lit(True))),
        "order_volume_metrics": daily.filter(F.col("event_date").isNotNull()).select("event_date", *_volume()),
        "eta_accuracy_metrics": with_deliveries.select(
            "event_date",
            "avg_eta_deviation",
            "delayed_deliveries",
            F.col("delivered_delay_rate").alias("delay_rate"),
        ),
    }


def top_days(volume: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest days: most orders, then most revenue, then the earlier day."""
    return volume.orderBy(F.desc("total_orders"), F.desc("total_revenue"), "event_date").limit(k)

"""Fixture rows."""

from dispatchlake.schemas import BRONZE_ORDERS

LOCATION = {"latitude": -3.25, "longitude": 41.5, "address": "Pier 4"}
SOUP = {"item_id": "dish-8", "name": "Soup", "quantity": 1.0, "unit_price": "4.20", "total_price": "4.20"}


def bronze(spark, *changes):
    """Bronze orders: one valid default row per dict of changes."""
    default = {
        "event_id": "1",
        "event_timestamp": "2025-02-10 10:00:00.000000",
        "order_id": "o-1",
        "merchant_id": "m-31",
        "customer_id": "c-7",
        "service_type": "groceries",
        "order_status": "delivered",
        "items": [],
        "delivery_location": LOCATION,
        "delivery_fee": "5.0",
        "total_amount": "100.0",
        "estimated_delivery_time": "2025-02-10 10:30:00.000000",
        "payment_method": "card",
        "payment_status": "completed",
    }
    return spark.createDataFrame([tuple({**default, **c}[n] for n in BRONZE_ORDERS.names) for c in changes], BRONZE_ORDERS)

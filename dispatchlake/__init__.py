"""Spark jobs for delivery order and courier events: lake, current state, warehouse and daily metrics."""

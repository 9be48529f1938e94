"""Feed names, message keys and landing paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dispatchlake.schemas import FEED_KEYS

DEFAULT_TOPIC_PATTERN = "{feed}-raw"


def topic_name(feed: str, pattern: str = DEFAULT_TOPIC_PATTERN) -> str:
    return pattern.format(feed=feed)


def message_key(topic: Column, fields: list[str], pattern: str = DEFAULT_TOPIC_PATTERN) -> Column:
    """The entity id of the topic's feed; other topics and records without that id fall back to the event id."""
    by_feed = [
        F.when(topic == F.lit(topic_name(feed, pattern)), F.col(field))
        for feed, field in FEED_KEYS.items()
        if field in fields
    ]
    return F.coalesce(*by_feed, F.col("event_id"))


def landing_path(topic: Column, landed_at: Column) -> Column:
    """``bronze/<topic, dots as folders>/<yyyy>/<MM>/<dd>/<HH>/<mmss>.parquet``."""
    return F.concat(
        F.lit("bronze/"),
        F.replace(topic, F.lit("."), F.lit("/")),
        F.lit("/"),
        F.date_format(landed_at, "yyyy/MM/dd/HH/mmss"),
        F.lit(".parquet"),
    )

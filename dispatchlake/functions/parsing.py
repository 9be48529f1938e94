"""Column expressions that turn wire text into typed values. Bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dispatchlake.schemas import TIMESTAMP_PATTERN

MONEY = "decimal(18,2)"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_time(value: Column | str) -> Column:
    """Lake spelling ``yyyy-MM-dd HH:mm:ss`` with or without microseconds."""
    return F.try_to_timestamp(col(value), F.lit(TIMESTAMP_PATTERN))


def parse_iso_time(value: Column | str) -> Column:
    """ISO-8601 with ``Z`` or a numeric offset; also accepts the lake spelling."""
    return col(value).try_cast("timestamp")


def to_double(value: Column | str) -> Column:
    return col(value).try_cast("double")


def to_float(value: Column | str) -> Column:
    return col(value).try_cast("float")


def money(value: Column | str) -> Column:
    """Exact money for sums and means; doubles drift at scale and tie differently."""
    return col(value).try_cast(MONEY)

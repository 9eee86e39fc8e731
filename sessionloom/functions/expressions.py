"""Column expressions; all of them are Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text form of a timestamp, and microseconds per minute.
TIMESTAMP_TEXT = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?\z"
MICROS_PER_MINUTE = 6e7


def parse_timestamp(text: Column) -> Column:
    """ISO date and time without a zone, fraction optional; any other text gives null.

    The cast reads the wall-clock value as it stands, so no session time zone is involved.
    Digits beyond microseconds are cut off.
    """
    return F.when(text.rlike(TIMESTAMP_TEXT), text.try_cast("timestamp_ntz"))


def micros_of(time: Column) -> Column:
    """Microseconds of a naive time since 1970, as a long."""
    return F.unix_micros(time.cast("timestamp"))


def span_micros(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end`` as a long; null if either is null.

    Naive times are read in the session time zone, which must be UTC (``session.require_utc``).
    """
    return micros_of(end) - micros_of(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes from ``start`` to ``end``."""
    return span_micros(start, end).cast("double") / F.lit(MICROS_PER_MINUTE)


def micros_to_minutes(micros: Column) -> Column:
    """Microseconds as minutes, divided in two steps as the metric is defined."""
    return micros.cast("double") / F.lit(1000000) / F.lit(60)


def whole_minutes(minutes: Column) -> Column:
    """Fractional minutes cut to an integer, towards zero."""
    return minutes.cast("int")


def order_flag(event_type: Column, order_type: str) -> Column:
    """1 for an order event, 0 for any other type and for a missing type."""
    return F.when(event_type == F.lit(order_type), 1).otherwise(0)

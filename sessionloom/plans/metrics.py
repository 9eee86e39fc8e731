"""The two order metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.columns import ORDER_TYPE, Columns
from sessionloom.functions.expressions import micros_to_minutes
from sessionloom.operators.median import exact_median, middle_values, midpoint
from sessionloom.operators.orders import OrderHistory

VISITS = "median_visits_before_order"
DURATION = "median_session_duration_minutes_before_order"


def _history(events: DataFrame, order_type: str, cols: Columns, options: dict) -> OrderHistory:
    return OrderHistory(events, order_type, cols, keep=(), **options)


def median_visits_of(history: OrderHistory) -> DataFrame:
    """Median number of sessions between orders, over all customers' order groups."""
    return exact_median(history.diffs(), "session_diff", VISITS)


def median_duration_of(history: OrderHistory) -> DataFrame:
    """Median minutes per session before a customer's first order."""
    return exact_median(history.durations(), "duration_micros", DURATION, micros_to_minutes)


def metrics_of(history: OrderHistory) -> DataFrame:
    """Both metrics in one row; a metric without any value is null."""
    figures, figure = history.figures(), F.col("figure")
    return middle_values(figures, "value", ["figure"]).agg(
        midpoint(lambda v: v.cast("double"), figure == "session_diff").alias(VISITS),
        midpoint(micros_to_minutes, figure == "duration_micros").alias(DURATION),
    )


def metrics_json_of(history: OrderHistory) -> DataFrame:
    """Both metrics as one JSON object in the column ``metrics``."""
    as_json = F.to_json(F.struct(VISITS, DURATION), {"ignoreNullFields": "false"})
    return metrics_of(history).select(as_json.alias("metrics"))


def median_visits_before_order(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """``median_visits_of`` for sessionized events."""
    return median_visits_of(_history(events, order_type, cols, options))


def median_session_duration_minutes_before_order(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """``median_duration_of`` for sessionized events."""
    return median_duration_of(_history(events, order_type, cols, options))


def order_metrics(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """``metrics_of`` for sessionized events."""
    return metrics_of(_history(events, order_type, cols, options))


def order_metrics_json(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """``metrics_json_of`` for sessionized events."""
    return metrics_json_of(_history(events, order_type, cols, options))

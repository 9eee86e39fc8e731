"""Session and order analytics for web-shop events, written for Spark DataFrames."""

from sessionloom.columns import Columns
from sessionloom.operators.history import HotCustomers, SplitRule, hot_customers
from sessionloom.operators.median import exact_median
from sessionloom.operators.orders import (
    before_first_order,
    order_groups,
    session_diffs,
    session_durations,
    with_order_number,
)
from sessionloom.operators.preview import view
from sessionloom.operators.sessions import resessionize, sessionize, session_columns
from sessionloom.plans.jobs import run_etl, run_load, run_metrics
from sessionloom.plans.metrics import (
    median_session_duration_minutes_before_order,
    median_visits_before_order,
    order_metrics,
    order_metrics_json,
)

__all__ = [
    "Columns",
    "HotCustomers",
    "SplitRule",
    "before_first_order",
    "exact_median",
    "hot_customers",
    "median_session_duration_minutes_before_order",
    "median_visits_before_order",
    "order_groups",
    "order_metrics",
    "order_metrics_json",
    "resessionize",
    "run_etl",
    "run_load",
    "run_metrics",
    "session_columns",
    "session_diffs",
    "session_durations",
    "sessionize",
    "view",
    "with_order_number",
]

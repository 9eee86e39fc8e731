"""The batch jobs: raw files to staged files, staged files to the table, the table to metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from sessionloom.columns import (
    DATABASE,
    DEFAULT_GAP_MINUTES,
    ORDER_TYPE,
    RAW_SCHEMA,
    TABLE,
    Columns,
)
from sessionloom.operators.history import SplitRule, hot_customers
from sessionloom.operators.sessions import sessionize
from sessionloom.plans.metrics import order_metrics_json
from sessionloom.session import folders_removed
from sessionloom.sources.raw import check_values, counted_values, read_events_json, typed_events
from sessionloom.sources.staged import read_staged, wait_until_staged, write_staged
from sessionloom.sources.warehouse import load_events, scan_events


def sessionize_raw(
    raw: DataFrame,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    cols: Columns = Columns(),
    *,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """Raw nested events to sessionized events."""
    return sessionize(typed_events(raw, cols=cols), gap_minutes, cols, rule=rule)


def run_etl(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    *,
    schema: T.StructType | None = RAW_SCHEMA,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """Read raw JSON, sessionize it, write staged files; gives the staged rows.

    The search for long histories reads the customers once, and counts on its way whether each field has
    any value; if one has none, nothing is written. The rows are written once; what long histories
    need in between is removed afterwards.
    """
    cols, seen = Columns(), Observation("fields")
    raw = read_events_json(spark, source, schema)
    searched = typed_events(raw, cols=cols, seen=seen)
    with folders_removed(spark):
        hot = hot_customers(searched, cols.customer, rule, cols.timestamp)
        # A search that has met no row at all leaves no counts behind.
        check_values(seen.get if hot.searched else counted_values(raw, cols=cols))
        events = typed_events(raw, cols=cols)
        write_staged(sessionize(events, gap_minutes, cols, hot=hot), target)
    return read_staged(spark, target)


def run_load(
    spark: SparkSession,
    staged: str,
    database: str = DATABASE,
    table: str = TABLE,
    *,
    location: str | None = None,
    wait: float | None = None,
) -> DataFrame:
    """Create the table if need be and fill it from staged files.

    With ``wait`` the job waits that many seconds for the files at most, if they are not there yet.
    """
    if wait is not None:
        wait_until_staged(spark, staged, wait)
    return load_events(spark, staged, database, table, location=location)


def run_metrics(
    spark: SparkSession,
    database: str = DATABASE,
    table: str = TABLE,
    order_type: str = ORDER_TYPE,
    *,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """Both order metrics of the table as one JSON object."""
    return order_metrics_json(scan_events(spark, database, table), order_type, rule=rule)

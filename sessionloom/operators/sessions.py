"""Sessionization: a customer's events split wherever the pause exceeds a limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.columns import DEFAULT_GAP_MINUTES, Columns
from sessionloom.operators.history import (
    HotCustomers,
    SplitRule,
    content_hash,
    hot_customers,
    numbered,
)
from sessionloom.session import require_utc


def known_customers(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Only events that name a customer."""
    return df.filter(F.col(cols.customer).isNotNull())


def one_customer(df: DataFrame, customer: int, cols: Columns = Columns()) -> DataFrame:
    """Only events of that customer; the filter reaches the scan."""
    return df.filter(F.col(cols.customer) == F.lit(customer))


def sort_events(df: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """All events by customer and time, missing values first.

    The hash of the whole row comes last, so that a large group of equal keys can be divided.
    """
    customer = F.col(cols.customer).asc_nulls_first()
    times = [F.col(c).asc_nulls_first() for c in (cols.timestamp, *cols.ties)]
    return df.orderBy(customer, *times, content_hash(df))


def session_columns(
    df: DataFrame,
    gaps: Sequence[float] = (DEFAULT_GAP_MINUTES,),
    cols: Columns = Columns(),
    *,
    hot: HotCustomers | None = None,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """All events of known customers, plus ``prev_timestamp``, ``time_diff`` and, for the i-th gap,
    ``new_session_<i>`` and ``session_number_<i>``.

    Every gap is served by the same shuffle and sort. Columns the caller does not select cost
    nothing: Spark drops their windows. Columns of these names in the input are replaced.
    """
    if not gaps or any(gap < 0 for gap in gaps):
        raise ValueError("session lengths must be given and not be negative")
    require_utc(df, cols.timestamp)
    added = [f"{name}_{i}" for i in range(len(gaps)) for name in ("new_session", "session_number")]
    events = known_customers(df, cols).drop("prev_timestamp", "time_diff", *added)
    hot = hot or hot_customers(events, cols.customer, rule, cols.timestamp)
    return numbered(events, cols, hot, gaps)


def sessionize(
    df: DataFrame,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    cols: Columns = Columns(),
    *,
    keep: Sequence[str] = (),
    hot: HotCustomers | None = None,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """Number each customer's sessions from 0; a pause of more than ``gap_minutes`` opens one.

    Gives customer, timestamp, time_diff (minutes since the previous event), new_session (0/1),
    session_number and type, after any columns named in ``keep``. Events without a customer are
    dropped. Events without a timestamp are kept; they come first and in session 0.
    """
    needed = dict.fromkeys([*keep, cols.customer, cols.timestamp, *cols.ties, cols.type])
    out = session_columns(df.select(*needed), [gap_minutes], cols, hot=hot, rule=rule)
    return out.select(
        *keep,
        cols.customer,
        cols.timestamp,
        "time_diff",
        F.col("new_session_0").alias("new_session"),
        F.col("session_number_0").alias(cols.session),
        cols.type,
    )


def resessionize(
    df: DataFrame,
    gaps: Sequence[float] = (DEFAULT_GAP_MINUTES,),
    cols: Columns = Columns(),
    *,
    keep: Sequence[str] = (),
    hot: HotCustomers | None = None,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """Sessionize events again with one or more other lengths, in one pass over the data.

    Takes raw or already sessionized events; one output row per event and length, the latter in
    ``gap_minutes``.
    """
    needed = dict.fromkeys([*keep, cols.customer, cols.timestamp, *cols.ties, cols.type])
    out = session_columns(df.select(*needed), gaps, cols, hot=hot, rule=rule)
    versions = F.array(
        *[
            F.struct(
                F.lit(float(gap)).alias("gap_minutes"),
                F.col(f"new_session_{i}").alias("new_session"),
                F.col(f"session_number_{i}").alias(cols.session),
            )
            for i, gap in enumerate(gaps)
        ]
    )
    return out.select(
        *keep, cols.customer, cols.timestamp, "time_diff", cols.type, F.inline(versions)
    ).select(
        "gap_minutes",
        *keep,
        cols.customer,
        cols.timestamp,
        "time_diff",
        "new_session",
        cols.session,
        cols.type,
    )

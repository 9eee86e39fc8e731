"""Small frames, and the results worked out in plain Python to compare with."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict
from statistics import median

from pyspark.sql import types as T

DAY = dt.datetime(2023, 1, 1)
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("type", T.StringType()),
    ]
)


def at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def story(spark, *events, customer=1):
    """One customer's events as (kind, minutes): kind 'O' is an order, 'v' is not."""
    rows = [
        (i, customer, at(minutes), "placed_order" if kind == "O" else "view")
        for i, (kind, minutes) in enumerate(events)
    ]
    return spark.createDataFrame(rows, EVENTS)


def minutes_between(a, b):
    return (b - a) // dt.timedelta(microseconds=1) / 6e7


def brute_sessions(rows, gap):
    """(event_id, customer, ts, type) -> the same plus (time_diff, new_session, session_number)."""
    by_customer = defaultdict(list)
    for row in rows:
        if row[1] is not None:
            by_customer[row[1]].append(row)
    out = []
    for history in by_customer.values():
        history.sort(key=lambda r: (r[2] is not None, r[2] or DAY, r[0]))
        number, prev = 0, None
        for event_id, customer, ts, kind in history:
            diff = minutes_between(prev, ts) if prev is not None and ts is not None else 0.0
            new = int(diff > gap)
            number += new
            out.append((event_id, customer, ts, kind, diff, new, number))
            prev = ts
    return out


def brute_orders(sessions, order_type="placed_order"):
    """event_id -> order number, counting orders at the same time; no time counts as latest."""
    key = lambda ts: (ts is None, ts or DAY)
    numbers = {}
    for event_id, customer, ts, *_ in sessions:
        numbers[event_id] = sum(
            1
            for _, other, when, kind, *_ in sessions
            if other == customer and kind == order_type and key(when) <= key(ts)
        )
    return numbers


def brute_metrics(sessions, order_type="placed_order"):
    """(session diffs, session durations) as sorted lists."""
    numbers = brute_orders(sessions, order_type)
    last = {}
    spans = defaultdict(list)
    for event_id, customer, ts, _, _, _, session in sessions:
        group = (customer, numbers[event_id])
        last[group] = max(last.get(group, session), session)
        if numbers[event_id] == 0:
            spans[customer, session].append(ts)
    diffs, prev = [], {}
    for customer, number in sorted(last):
        diffs.append(last[customer, number] - prev.get(customer, 0))
        prev[customer] = last[customer, number]
    durations = []
    for times in spans.values():
        known = [t for t in times if t is not None]
        durations.append(minutes_between(min(known), max(known)) if known else None)
    return sorted(diffs), durations


def brute_medians(sessions):
    diffs, durations = brute_metrics(sessions)
    known = [d for d in durations if d is not None]
    return (
        float(median(diffs)) if diffs else None,
        float(median(known)) if known else None,
    )


def bag(df, *columns):
    """The rows of those columns with their counts, in no order."""
    return Counter(tuple(row) for row in df.select(*columns).collect())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """The plan that has run, without the one it started from."""
    return plan_of(df).split("+- == Initial Plan ==")[0]

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracle.duck(sf_dir)


OWN = set(entry.queries()) - set(entry._llm("queries"))


def test_every_query_has_its_sql():
    assert OWN <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    row = entry.entry(spark).collect()
    assert len(row) == 1 and None not in tuple(row[0])


# The split way of each step is checked against brute force; here only whole results are.
# ``check_oracle.py`` runs every query.
SPLIT_RESULTS = ("sessionize", "resessionize", "order_metrics", "session_bounds_ties")
NAMES = [
    name
    for name in sorted(OWN)
    if not name.endswith("_split") or name.startswith(SPLIT_RESULTS)
]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf_dir, name):
    same, note = check_oracle.compared(spark, con, name, sf_dir)
    assert same, note


# Rows, new sessions, sum of session numbers, order groups, sessions before the first
# order, median and mean of session_diff, median and mean of the duration.
GOLDEN = {
    ("plain", 30): (1000, 931, 31593, 215, 58, 3.0, 4.330233, 0.0, 0.515112),
    ("plain", 480): (1000, 477, 15491, 215, 35, 2.0, 2.218605, 0.0, 155.586499),
    ("ties", 480): (1000, 443, 14263, 212, 30, 2.0, 2.089623, 0.0, 228.0),
    ("nulls", 480): (923, 448, 12775, 203, 33, 2.0, 0.876847, 0.0, 151.588381),
}


@pytest.mark.parametrize("rule", [entry.WHOLE, entry.SPLIT], ids=["whole", "split"])
@pytest.mark.parametrize("case", GOLDEN, ids=str)
def test_golden(spark, sf_dir, case, rule):
    from pyspark.sql import functions as F

    from sessionloom import order_metrics
    from sessionloom.operators.orders import OrderHistory

    kind, gap = case
    sessions = entry._sessions(spark, sf_dir, kind, gap, rule)
    rows = sessions.agg(F.count("*"), F.sum("new_session"), F.sum("session_number")).first()
    history = OrderHistory(sessions, entry.ORDER[kind], entry.COLS, rule=rule)
    diffs = history.diffs().agg(F.count("*"), F.avg("session_diff")).first()
    minutes = history.durations().agg(F.count("*"), F.avg("session_duration")).first()
    visits, duration = order_metrics(sessions, entry.ORDER[kind], entry.COLS, rule=rule).first()
    got = (*rows, diffs[0], minutes[0], visits, diffs[1], duration, minutes[1])
    assert got == pytest.approx(GOLDEN[case], abs=1e-6)

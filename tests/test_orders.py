from collections import Counter

import pytest
from helpers import EVENTS, bag, brute_medians, brute_metrics, brute_orders, brute_sessions, plan_of, story
from pyspark.sql import functions as F
from test_sessions import SPLIT, WAYS, random_rows

import sessionloom as sl
from sessionloom import Columns, SplitRule
from sessionloom.operators.orders import OrderHistory, with_order_flag

COLS = Columns(tie=("event_id",))


def sessions_of(spark, *events, gap=30):
    return sl.sessionize(story(spark, *events), gap, COLS, keep=["event_id"])


def values(df, column):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda v: (v is None, v))


def test_order_flag(spark):
    df = story(spark, ("v", 0), ("O", 1)).unionByName(
        story(spark, ("v", 2)).withColumn("type", F.lit(None).cast("string"))
    )
    flags = [r.placed_order for r in with_order_flag(df).orderBy("timestamp").collect()]
    assert flags == [0, 1, 0]


@WAYS
def test_events_at_the_time_of_an_order_count_it(spark, rule):
    out = sl.with_order_number(sessions_of(spark, ("v", 0), ("v", 10), ("O", 10)), rule=rule)
    assert [r.order_number for r in out.orderBy("event_id").collect()] == [0, 1, 1]


@WAYS
def test_missing_time_counts_all_orders(spark, rule):
    df = sessions_of(spark, ("v", None), ("v", 0), ("O", 10), ("O", None))
    out = sl.with_order_number(df, rule=rule).orderBy("event_id")
    assert [r.order_number for r in out.collect()] == [2, 0, 1, 2]


# (events, session diffs, minutes before the first order)
STORIES = {
    "never ordered": ([("v", 0), ("v", 60)], [1], [0.0, 0.0]),
    "order first": ([("O", 0), ("v", 60)], [1], []),
    "session cut at the order": ([("v", 0), ("v", 10), ("O", 20), ("v", 25)], [0, 0], [10.0]),
    "trailing group": ([("v", 0), ("O", 60), ("v", 120)], [0, 2], [0.0]),
    "no time at all": ([("v", None)], [0], [None]),
    "two orders at once": ([("v", 0), ("O", 60), ("O", 60), ("O", 200)], [0, 1, 1], [0.0]),
}


@WAYS
@pytest.mark.parametrize("case", STORIES)
def test_stories(spark, case, rule):
    events, diffs, minutes = STORIES[case]
    df = sessions_of(spark, *events)
    assert values(sl.session_diffs(df, rule=rule), "session_diff") == diffs
    assert values(sl.session_durations(df, rule=rule), "session_duration") == minutes


def test_stories_give_the_medians(spark):
    row = sl.order_metrics(sessions_of(spark, *STORIES["trailing group"][0])).first()
    assert tuple(row) == (1.0, 0.0)
    row = sl.order_metrics(sessions_of(spark, *STORIES["order first"][0])).first()
    assert tuple(row) == (1.0, None)


@WAYS
def test_no_events_give_one_row_of_nulls(spark, rule):
    empty = sl.sessionize(spark.createDataFrame([], EVENTS), 30)
    for metrics in (sl.order_metrics(empty, rule=rule),):
        assert [tuple(r) for r in metrics.collect()] == [(None, None)]
    assert [tuple(r) for r in sl.median_visits_before_order(empty, rule=rule).collect()] == [(None,)]


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("rule", [SplitRule(), SPLIT, SplitRule(20, 100)])
def test_against_brute_force(spark, seed, rule):
    rows = random_rows(seed)
    brute = brute_sessions(rows, 30)
    df = sl.sessionize(spark.createDataFrame(rows, EVENTS).repartition(5), 30, COLS, keep=["event_id"])
    history = OrderHistory(df, "placed_order", COLS, rule=rule)
    assert bag(history.events(), "event_id", "order_number") == Counter(brute_orders(brute).items())
    diffs, durations = brute_metrics(brute)
    assert values(history.diffs(), "session_diff") == diffs
    got = Counter(r[0] for r in history.durations().select("session_duration").collect())
    assert {k and round(k, 9): n for k, n in got.items()} == Counter(
        d and round(d, 9) for d in durations
    )
    figures = Counter(tuple(r) for r in history.figures().filter("value is not null").collect())
    micros = [None if d is None else round(d * 6e7) for d in durations]
    assert figures == Counter(
        [("session_diff", d) for d in diffs]
        + [("duration_micros", m) for m in micros if m is not None]
    )
    got = tuple(sl.order_metrics(df, "placed_order", COLS, rule=rule).first())
    assert got == pytest.approx(brute_medians(brute))


@pytest.mark.parametrize("rule", [SPLIT, SplitRule(5, 25)])
def test_a_third_of_all_rows_at_one_time(spark, rule):
    rows = random_rows(13)
    rows += [(10_000 + i, 5, rows[0][2], "placed_order" if i % 9 == 0 else "view") for i in range(len(rows) // 2)]
    rows += [(50_000 + i, 6, None, "placed_order" if i % 7 == 0 else "view") for i in range(300)]
    df = spark.createDataFrame(rows, EVENTS).repartition(7)
    whole = sl.sessionize(df, 30, COLS, keep=["event_id"])
    cut = sl.sessionize(df, 30, COLS, keep=["event_id"], rule=rule)
    columns = ("event_id", "customer_id", "time_diff", "new_session", "session_number")
    assert bag(whole, *columns) == bag(cut, *columns)
    a, b = OrderHistory(whole), OrderHistory(whole, rule=rule)
    for step in ("events", "lagged", "durations", "with_last_session", "with_session_bounds"):
        left, right = getattr(a, step)(), getattr(b, step)()
        assert bag(left, *left.columns) == bag(right, *left.columns), step
    assert sl.order_metrics(whole).first() == sl.order_metrics(whole, rule=rule).first()


@pytest.mark.parametrize("rule", [SplitRule(), SPLIT])
def test_event_values_reduce_to_group_values(spark, rule):
    df = sl.sessionize(spark.createDataFrame(random_rows(14), EVENTS), 30, COLS, keep=["event_id"])
    history = OrderHistory(df, rule=rule)
    names = ("customer_id", "order_number", "max_session_for_order")
    assert bag(history.with_last_session().select(*names).distinct(), *names) == bag(
        history.groups(), *names
    )
    bounds = history.with_session_bounds().select(
        "customer_id",
        "session_number",
        F.unix_micros(F.col("max_session_event").cast("timestamp"))
        - F.unix_micros(F.col("min_session_event").cast("timestamp")),
    )
    assert bag(bounds.distinct(), *bounds.columns) == bag(
        history.durations(), "customer_id", "session_number", "duration_micros"
    )


def test_sessions_out_of_time_order(spark):
    # Session numbers need not rise with time in a table from elsewhere.
    df = sessions_of(spark, ("v", 0), ("v", 60), ("O", 70), ("v", 140), ("O", 200), ("v", 300))
    df = df.withColumn("session_number", F.element_at(F.array(*[F.lit(v) for v in (5, 2, 9, 1, 4, 3)]), (F.col("event_id") + 1).cast("int")))
    history = OrderHistory(df)
    want = values(history.diffs(), "session_diff")
    figures = history.figures().filter("figure = 'session_diff'")
    assert values(figures, "value") == want == [-5, 4, 5]


def test_several_numbers_per_group_are_one_row(spark):
    df = sessions_of(spark, ("v", 0), ("v", 60), ("O", 90))
    groups = sl.order_groups(df)
    assert bag(groups, "order_number", "max_session_for_order") == Counter([(0, 1), (1, 1)])


def test_metrics_shuffle_events_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cols = Columns("user_id", "ts", "event_type", "visit", ("event_id",))
    numbered = sl.sessionize(events, 30, cols)
    plan = plan_of(OrderHistory(numbered, "purchase", cols, keep=()).figures())
    assert plan.count("Exchange ") == 1 and plan.count("FileScan") == 1
    assert "props" not in plan


def test_json(spark):
    df = sessions_of(spark, *STORIES["order first"][0])
    text = sl.order_metrics_json(df).first()[0]
    assert text == (
        '{"median_visits_before_order":1.0,"median_session_duration_minutes_before_order":null}'
    )

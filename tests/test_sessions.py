import datetime as dt
import random
from collections import Counter

import pytest
from helpers import DAY, EVENTS, at, bag, brute_sessions, final_plan_of, plan_of, story
from pyspark.sql import functions as F

from sessionloom import Columns, SplitRule, hot_customers, resessionize, sessionize
from sessionloom.operators import history
from sessionloom.operators.sessions import known_customers, session_columns, sort_events

COLS = Columns(tie=("event_id",))
SPLIT = SplitRule(hot_rows=3, slice_rows=60)
WAYS = pytest.mark.parametrize("rule", [SplitRule(), SplitRule(0, 2)], ids=["whole", "split"])
RESULT = ("event_id", "customer_id", "timestamp", "type", "time_diff", "new_session", "session_number")


def numbers(df, gap=30, rule=SplitRule()):
    out = sessionize(df, gap, COLS, keep=["event_id"], rule=rule).orderBy("event_id")
    return [tuple(r) for r in out.select("time_diff", "new_session", "session_number").collect()]


@WAYS
def test_gap_at_the_limit_stays_in_the_session(spark, rule):
    over = 60 + 1 / 6e7
    got = numbers(story(spark, ("v", 0), ("v", 30), ("v", over), ("v", 91)), rule=rule)
    assert [n for _, _, n in got] == [0, 0, 1, 2]


def test_spark_session_window_draws_the_same_line(spark):
    df = story(spark, ("v", 0), ("v", 30), ("v", 60 + 1 / 6e7), ("v", 91))
    windows = df.groupBy("customer_id", F.session_window("timestamp", "30 minutes")).count()
    assert sorted(r["count"] for r in windows.collect()) == [1, 1, 2]


@WAYS
def test_numbers_start_at_zero(spark, rule):
    assert numbers(story(spark, ("v", 5)), rule=rule) == [(0.0, 0, 0)]


@WAYS
def test_tie_opens_one_session(spark, rule):
    got = numbers(story(spark, ("v", 0), ("v", 60), ("v", 60)), rule=rule)
    assert got == [(0.0, 0, 0), (60.0, 1, 1), (0.0, 0, 1)]


@WAYS
def test_missing_time_comes_first(spark, rule):
    got = numbers(story(spark, ("v", None), ("v", 0), ("v", 60)), rule=rule)
    assert got == [(0.0, 0, 0), (0.0, 0, 0), (60.0, 1, 1)]


def test_reversing_ties_keeps_session_numbers(spark):
    df = story(spark, ("v", 0), ("v", 60), ("v", 60), ("v", 60), ("v", 100))
    back = df.withColumn("turned", -F.col("event_id"))
    a = sessionize(df, 30, COLS, keep=["event_id"])
    b = sessionize(back, 30, Columns(tie=("turned",)), keep=["event_id"])
    assert bag(a, "event_id", "session_number") == bag(b, "event_id", "session_number")
    assert bag(a, "event_id", "new_session") != bag(b, "event_id", "new_session")


def test_columns_and_types(spark):
    out = sessionize(story(spark, ("v", 0)), 30)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("customer_id", "bigint"),
        ("timestamp", "timestamp_ntz"),
        ("time_diff", "double"),
        ("new_session", "int"),
        ("session_number", "bigint"),
        ("type", "string"),
    ]


def test_other_column_names(spark):
    df = story(spark, ("v", 0), ("v", 31)).toDF("no", "who", "when", "what")
    out = sessionize(df, 30, Columns("who", "when", "what", "visit", ("no",)))
    assert out.columns == ["who", "when", "time_diff", "new_session", "visit", "what"]
    assert sorted(r.visit for r in out.collect()) == [0, 1]


def test_empty_input(spark):
    assert sessionize(spark.createDataFrame([], EVENTS), 30, rule=SPLIT).count() == 0


def test_bad_length(spark):
    with pytest.raises(ValueError):
        sessionize(story(spark, ("v", 0)), -1)


def test_a_zone_that_bends_naive_times_is_refused(spark):
    df = story(spark, ("v", 0))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            sessionize(df, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_customers_are_dropped(spark):
    df = story(spark, ("v", 0)).unionByName(story(spark, ("v", 1), customer=None))
    assert known_customers(df).count() == 1
    assert sessionize(df, 30, COLS).count() == 1


def test_sort_puts_missing_first(spark):
    rows = [(0, 2, at(0), "v"), (1, 1, at(5), "v"), (2, 1, None, "v"), (3, None, at(9), "v")]
    got = sort_events(spark.createDataFrame(rows, EVENTS), COLS).collect()
    assert [r.event_id for r in got] == [3, 2, 1, 0]


def random_rows(seed, customers=60, most=40, identical=False):
    """Histories of all lengths on a coarse clock, with many ties and some missing values."""
    rng = random.Random(seed)
    rows = []
    for customer in range(customers):
        for _ in range(rng.randint(1, most)):
            minutes = None if rng.random() < 0.1 else rng.randrange(0, 600, 15)
            kind = "placed_order" if rng.random() < 0.2 else "view"
            rows.append((customer if rng.random() > 0.05 else None, at(minutes), kind))
    rng.shuffle(rows)
    return [(0 if identical else i, *row) for i, row in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rule", [SplitRule(), SPLIT, SplitRule(20, 50)])
def test_against_brute_force(spark, seed, rule):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, EVENTS).repartition(5)
    got = bag(sessionize(df, 30, COLS, keep=["event_id"], rule=rule), *RESULT)
    assert got == Counter(brute_sessions(rows, 30))


@pytest.mark.parametrize("rule", [SplitRule(), SPLIT])
def test_equal_rows_are_all_kept(spark, rule):
    # A third of all rows are one and the same, and have no time.
    rows = random_rows(3, identical=True)
    rows += [(0, 7, None, "view")] * (len(rows) // 2) + [(0, 8, at(300), "view")] * 200
    df = spark.createDataFrame(rows, EVENTS).repartition(6)
    got = bag(sessionize(df, 30, Columns(), keep=["event_id"], rule=rule), *RESULT)
    plain = bag(sessionize(df, 30, Columns(), keep=["event_id"]), *RESULT)
    assert got == plain
    assert sum(got.values()) == sum(1 for r in rows if r[1] is not None)


def test_other_columns_ride_along(spark):
    df = spark.createDataFrame(random_rows(8), EVENTS).withColumn("more", F.create_map("type", "event_id"))
    whole = session_columns(df, [30], COLS)
    cut = session_columns(df, [30], COLS, rule=SPLIT)
    names = ("event_id", "prev_timestamp", "time_diff", "new_session_0", "session_number_0")
    assert cut.columns == whole.columns and bag(cut, *names) == bag(whole, *names)
    assert {tuple(r) for r in cut.select(F.map_values("more")[0] == F.col("event_id")).collect()} == {(True,)}


def test_longer_gaps_never_give_more_sessions(spark):
    df = spark.createDataFrame(random_rows(4), EVENTS)
    out = resessionize(df, [0, 15, 30, 60, 240], COLS, keep=["event_id"])
    sums = out.groupBy("gap_minutes").agg(F.sum("new_session").alias("n")).orderBy("gap_minutes")
    counts = [r.n for r in sums.collect()]
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]


@pytest.mark.parametrize("rule", [SplitRule(), SPLIT])
def test_several_gaps_equal_one_at_a_time(spark, rule):
    df = spark.createDataFrame(random_rows(5), EVENTS)
    both = resessionize(sessionize(df, 15, COLS, keep=["event_id"]), [30, 60], COLS, keep=["event_id"], rule=rule)
    for gap in (30, 60):
        alone = sessionize(df, gap, COLS, keep=["event_id"])
        assert bag(both.filter(F.col("gap_minutes") == gap), *RESULT) == bag(alone, *RESULT)


def test_windows_agree_with_spark_session_window(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("event_type").alias("type"),
    )
    ours = (
        sessionize(events, 480, COLS)
        .groupBy("customer_id", "session_number")
        .agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"), F.count("*").alias("n"))
    )
    theirs = events.groupBy("customer_id", F.session_window("timestamp", "480 minutes")).agg(
        F.min("timestamp").alias("a"), F.max("timestamp").alias("b"), F.count("*").alias("n")
    )
    assert bag(ours, "customer_id", "a", "b", "n") == bag(theirs, "customer_id", "a", "b", "n")


def test_hot_customers_are_found(spark):
    rows = [(i, i % 10 if i < 50 else 3, DAY + dt.timedelta(minutes=i), "v") for i in range(100)]
    df = spark.createDataFrame(rows, EVENTS)
    hot = hot_customers(df, "customer_id", SplitRule(10, 20))
    (row,) = hot.cuts.collect()
    assert row.customer == 3 and len(row.cuts) == 3 and row.cuts == sorted(row.cuts)
    assert not row.crowded and row.missing == 1 and hot.small and hot.searched == 100
    assert hot_customers(df, "customer_id").cuts is None


def test_hot_customers_are_found_in_a_sample(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("customer_id"),
        F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("timestamp"),
    )
    hot = hot_customers(df, "customer_id", SplitRule(hot_rows=20_000, slice_rows=10_000))
    (row,) = hot.cuts.collect()
    assert row.customer == -1 and 6 <= len(row.cuts) <= 8


def test_crowded_instants_get_parts(spark):
    minutes = [0] * 60 + list(range(1, 41)) + [None] * 50
    df = story(spark, *[("v", m) for m in minutes])
    hot = hot_customers(df, "customer_id", SplitRule(10, 10))
    (row,) = hot.cuts.collect()
    assert hot.crowded and row.missing == 5
    assert [c.parts > 1 for c in row.crowded] == [True] and row.crowded[0].at == row.cuts[0]
    assert numbers(df, rule=SplitRule(10, 10)) == numbers(df)


@pytest.mark.parametrize("limit", [0, 5])
def test_long_lists_are_joined_without_a_broadcast(spark, monkeypatch, limit):
    rows = random_rows(9, customers=40)
    monkeypatch.setattr(history, "BROADCAST_CUTS", limit)
    df = spark.createDataFrame(rows, EVENTS).repartition(3)
    hot = hot_customers(df.filter("customer_id is not null"), "customer_id", SplitRule(2, 4))
    assert not hot.small and hot.cuts.count() > 30  # many more than the limit, and none is left out
    got = sessionize(df, 30, COLS, keep=["event_id"], hot=hot)
    assert bag(got, *RESULT) == Counter(brute_sessions(rows, 30))


def test_many_cuts_are_counted_in_two_steps(spark):
    rows = [(i, 1, DAY + dt.timedelta(minutes=7 * i % 5000), "v") for i in range(700)]
    df = spark.createDataFrame(rows, EVENTS).repartition(5)
    hot = hot_customers(df, "customer_id", SplitRule(10, 5))
    assert len(hot.cuts.first().cuts) > 100
    got = sessionize(df, 30, COLS, keep=["event_id"], hot=hot)
    assert bag(got, *RESULT) == Counter(brute_sessions(rows, 30))


TAKEN = ("_slice", "_row", "_run", "_run_0", "_head", "_prev", "_last", "_hot", "_h_slice", "_h_part")


@pytest.mark.parametrize("rule", [SPLIT, SplitRule(0, 5)])
def test_columns_of_any_name_and_type_ride_along(spark, rule):
    from sessionloom.operators.orders import OrderHistory

    df = spark.createDataFrame(random_rows(15), EVENTS).repartition(4)
    for i, name in enumerate(TAKEN):
        df = df.withColumn(name, F.col("event_id") * 100 + i)
    df = df.withColumn("variant", F.parse_json(F.to_json(F.struct("event_id"))))
    df = df.withColumn("pairs", F.create_map("type", "event_id"))
    keep = ["event_id", *TAKEN, "variant", "pairs"]

    def plain(out):
        out = out.withColumns({"variant": F.col("variant").cast("string"), "pairs": F.to_json("pairs")})
        return bag(out, *sorted(out.columns))

    whole = sessionize(df, 30, COLS, keep=keep)
    assert plain(sessionize(df, 30, COLS, keep=keep, rule=rule)) == plain(whole)
    numbered = OrderHistory(whole, "placed_order", COLS).events()
    assert plain(OrderHistory(whole, "placed_order", COLS, rule=rule).events()) == plain(numbered)
    both = OrderHistory.of_events(df, 30, "placed_order", COLS, keep=keep, rule=rule)
    assert plain(both.events()) == plain(numbered)
    for step in ("with_last_session", "with_session_bounds"):
        assert plain(getattr(both, step)()) == plain(getattr(OrderHistory(whole, cols=COLS), step)())


def test_one_shuffle_and_pruned_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = sessionize(events, 30, Columns("user_id", "ts", "event_type", tie=("event_id",)))
    plan = plan_of(out)
    assert plan.count("Exchange ") == 1 and "hashpartitioning(user_id" in plan
    assert plan.count(" Sort [") == 1
    assert "PushedFilters: [IsNotNull(user_id)]" in plan
    assert "props" not in plan and "value" not in plan


def test_unused_windows_are_dropped(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cols = Columns("user_id", "ts", "event_type", tie=("event_id",))
    plan = plan_of(session_columns(events, [30], cols).select("user_id"))
    assert "Window" not in plan and "Exchange" not in plan


def test_split_plan_shuffles_the_events_once(spark, sf_dir):
    from sessionloom.operators.orders import OrderHistory

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cols = Columns("user_id", "ts", "event_type", "visit", ("event_id",))
    rule = SplitRule(10, 20)
    out = OrderHistory.of_events(events, 480, "purchase", cols, rule=rule).figures()
    out.collect()
    plan = final_plan_of(out)
    # The rows, the slices' carried values, and both figures: one scan and one shuffle of events.
    assert plan.count("FileScan") == 1
    slices = [x for x in plan.splitlines() if "Exchange hashpartitioning(user_id" in x and "_slice" in x]
    assert len([x for x in slices if "ReusedExchange" not in x]) == 1 < len(slices)

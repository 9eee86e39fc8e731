"""What is kept up to date, merged or found without a full pass: against a recomputation in plain Python."""

import datetime as dt
import random
from collections import Counter, defaultdict
from statistics import median

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sessionloom as sl
from helpers import EVENTS, at, bag, brute_medians, brute_metrics, brute_sessions, final_plan_of, plan_of
from sessionloom.columns import Columns
from sessionloom.operators import sketch
from sessionloom.operators.history import SplitRule
from sessionloom.operators.late import merge_late
from sessionloom.operators.median import exact_median, median_by
from sessionloom.operators.spectrum import gap_spectrum, merged_spectra, sessions_by_gap
from sessionloom.plans.standing import StandingMetrics, open_values
from sessionloom.session import work_folder
from sessionloom.sources import clustered
from sessionloom.streaming import numbering

COLS = Columns(tie=("event_id",))
KINDS = ("placed_order", "view", "view", None)


def history(rng, n, low, high, first_id=0, customers=9):
    """Random events between two times, with ties, missing customers, times and types."""
    return [
        (
            first_id + i,
            rng.randrange(customers) if rng.random() > 0.05 else None,
            at(rng.randrange(low, high)) if rng.random() > 0.08 else None,
            rng.choice(KINDS),
        )
        for i in range(n)
    ]


def values(metrics: StandingMetrics):
    rows = metrics.closed().unionByName(open_values(metrics.customers()))
    out = Counter()
    for r in rows.collect():
        out[r.figure, r.value] += r.n
    return out


def values_by_hand(rows, gap=30):
    diffs, durations = brute_metrics(brute_sessions(rows, gap))
    out = Counter(("session_diff", d) for d in diffs)
    out.update(("duration_micros", round(d * 6e7)) for d in durations if d is not None)
    return out


# --- standing metrics -----------------------------------------------------------------------------


@pytest.mark.parametrize("rule", [SplitRule(), SplitRule(5, 3)], ids=["whole", "split"])
def test_metrics_after_loads(spark, rule):
    rng, seen = random.Random(3), []
    standing = StandingMetrics(spark, work_folder(spark, "standing"), 30, cols=COLS, rule=rule)
    assert tuple(standing.metrics().first()) == (None, None)
    for i, (low, high) in enumerate([(0, 300), (300, 600), (600, 640)]):
        load = history(rng, 50, low, high, 1000 * i)
        standing.add(spark.createDataFrame(load, EVENTS), f"load {i}")
        seen += load
        assert values(standing) == values_by_hand(seen)
    assert tuple(standing.metrics().first()) == brute_medians(brute_sessions(seen, 30))
    # The same load again, and an empty one, change nothing.
    standing.add(spark.createDataFrame(load, EVENTS), "load 2")
    standing.add(spark.createDataFrame([], EVENTS), "empty")
    assert values(standing) == values_by_hand(seen)


def test_late_load_needs_the_history_of_its_customers(spark):
    rng = random.Random(4)
    first, late = history(rng, 80, 0, 500, customers=12), history(rng, 20, 0, 700, 1000, customers=5)
    standing = StandingMetrics(spark, work_folder(spark, "standing"), 30, cols=COLS)
    standing.add(spark.createDataFrame(first, EVENTS), "a")
    with pytest.raises(ValueError, match="earlier events"):
        standing.add(spark.createDataFrame(late, EVENTS), "b")
    assert values(standing) == values_by_hand(first) and list(standing.loads()) == ["a"]
    standing.add(spark.createDataFrame(late, EVENTS), "b", history=spark.createDataFrame(first, EVENTS))
    assert values(standing) == values_by_hand(first + late)
    standing.compact()
    assert values(standing) == values_by_hand(first + late) and list(standing.loads()) == ["a", "b"]
    more = history(rng, 40, 700, 900, 2000, customers=14)
    standing.add(spark.createDataFrame(more, EVENTS), "c")
    assert values(standing) == values_by_hand(first + late + more)


def test_a_load_that_fails_is_not_seen(spark, monkeypatch):
    rng = random.Random(5)
    first, second = history(rng, 40, 0, 100), history(rng, 40, 100, 200, 1000)
    standing = StandingMetrics(spark, work_folder(spark, "standing"), 30, cols=COLS)
    standing.add(spark.createDataFrame(first, EVENTS), "a")
    from sessionloom.sources.manifest import Manifest

    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(Manifest, "_put", crash)
    with pytest.raises(RuntimeError, match="crash"):
        standing.add(spark.createDataFrame(second, EVENTS), "b")
    monkeypatch.undo()
    assert values(standing) == values_by_hand(first)
    standing.add(spark.createDataFrame(second, EVENTS), "b")
    assert values(standing) == values_by_hand(first + second)


# --- numbers on a stream --------------------------------------------------------------------------


def test_stream_numbers_go_on_after_a_restart(spark, tmp_path):
    rng, parts = random.Random(6), []
    for i, (low, high) in enumerate([(0, 200), (200, 400), (350, 500)]):
        parts.append(history(rng, 60, low, high, 1000 * i, customers=5))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    store = spark.conf.get(numbering.STATE_STORE)
    numbering.use_rocks_db(spark)
    try:
        for part in parts:
            spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
            events = spark.readStream.schema(EVENTS).parquet(source)
            rows = numbering.stream_session_numbers(events, 30, COLS, keep=["event_id"])
            query = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
            query.trigger(availableNow=True).start(out).awaitTermination()
    finally:
        spark.conf.set(numbering.STATE_STORE, store)
    got = spark.read.parquet(out).collect()
    # What is older than the last event of its customer, in an earlier part, is late.
    late, last = set(), {}
    for part in parts:
        late |= {e for e, c, t, _ in part if c is not None and t and c in last and t < last[c]}
        for e, c, t, _ in part:
            if c is not None and t and e not in late:
                last[c] = max(last.get(c, t), t)
    assert {r.event_id for r in got if r.late} == late and late
    assert all(r.session_number is None and r.time_diff is None for r in got if r.late)
    in_order = [r for part in parts for r in part if r[0] not in late]
    want = Counter((e, c, t, d, n, s) for e, c, t, _, d, n, s in brute_sessions(in_order, 30))
    names = ("event_id", "customer_id", "timestamp", "time_diff", "new_session", "session_number")
    assert Counter(tuple(r[c] for c in names) for r in got if not r.late) == want


def test_state_is_read_and_written_by_bucket():
    class Held:
        value, calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

    class Handle:
        held = Held()

        def getValueState(self, name, schema):
            return self.held

    rng, handle = random.Random(9), Handle()
    numbers = numbering._Numbers(30, T.StructField("customer_id", T.StringType()), ["event_id"])
    numbers.init(handle)
    row = Row("event_id", "customer_id", "timestamp", "type", "_micros", "_bucket")
    parts = [[e for e in history(rng, 80, low, high, 1000 * i, customers=7) if e[1] is not None]
             for i, (low, high) in enumerate([(0, 200), (201, 400)])]
    got = Counter()
    for part in parts:
        made = [row(e, str(c), t, k, (t - at(0)) // dt.timedelta(microseconds=1) if t else None, 5) for e, c, t, k in part]
        for r in numbers.handleInputRows((5,), iter(made), None):
            got[r.event_id, int(r.customer_id), r.timestamp, r.time_diff, r.new_session, r.session_number] += 1
            assert not r.late
    want = Counter((e, c, t, d, n, s) for e, c, t, _, d, n, s in brute_sessions([r for p in parts for r in p], 30))
    assert got == want and handle.held.calls == 4
    # A batch that moves nobody on leaves the state as it is.
    assert len(list(numbers.handleInputRows((5,), iter([row(1, "1", None, "view", None, 5)]), None))) == 1
    assert handle.held.calls == 5


# --- late events ----------------------------------------------------------------------------------


@pytest.mark.parametrize("rule", [SplitRule(), SplitRule(5, 3)], ids=["whole", "split"])
def test_late_events_equal_a_full_run(spark, rule):
    rng = random.Random(7)
    first, late = history(rng, 150, 0, 600, customers=20), history(rng, 25, 0, 700, 1000, customers=6)
    late += [(2000, 77, at(5), "view"), (2001, 77, at(90), "view")]  # a new customer
    sessions = sl.sessionize(spark.createDataFrame(first, EVENTS), 30, COLS, keep=["event_id"])
    merged = merge_late(sessions, spark.createDataFrame(late, EVENTS), 30, COLS, keep=["event_id"], rule=rule)
    whole = sl.sessionize(spark.createDataFrame(first + late, EVENTS), 30, COLS, keep=["event_id"])
    assert merged.events().columns == whole.columns
    assert bag(merged.events(), *whole.columns) == bag(whole, *whole.columns)
    touched = {c for _, c, _, _ in late if c is not None}
    assert {r.customer_id for r in merged.rewritten.collect()} == touched
    assert not {r.customer_id for r in merged.untouched.collect()} & touched
    none = merge_late(sessions, spark.createDataFrame([], EVENTS), 30, COLS, keep=["event_id"])
    assert none.rewritten.count() == 0 and bag(none.untouched, *whole.columns) == bag(sessions, *whole.columns)


def test_untouched_rows_are_not_shuffled(spark, tmp_path):
    rng = random.Random(8)
    path = str(tmp_path / "sessions")
    sessions = sl.sessionize(spark.createDataFrame(history(rng, 50, 0, 99), EVENTS), 30, COLS, keep=["event_id"])
    sessions.write.parquet(path)
    late = spark.createDataFrame([(900, 3, at(1), "view")], EVENTS)
    merged = merge_late(spark.read.parquet(path), late, 30, COLS, keep=["event_id"])
    plan = plan_of(merged.untouched)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


# --- spectrum -------------------------------------------------------------------------------------


@pytest.mark.parametrize("rule", [SplitRule(), SplitRule(5, 3)], ids=["whole", "split"])
def test_sessions_for_any_length(spark, rule):
    rows = history(random.Random(9), 200, 0, 900, customers=12)
    gaps = [0, 0.5, 1, 7, 30, 31, 100, 2000, 30]
    spectrum = gap_spectrum(spark.createDataFrame(rows, EVENTS), COLS, rule=rule)
    total = {r.gap_minutes: r.sessions for r in sessions_by_gap(spectrum, gaps).collect()}
    each = {(r.customer_id, r.gap_minutes): r.sessions for r in sessions_by_gap(spectrum, gaps, ["customer_id"]).collect()}
    for gap in gaps:
        last = defaultdict(int)
        for _, customer, _, _, _, _, session in brute_sessions(rows, gap):
            last[customer] = max(last[customer], session)
        assert total[gap] == sum(n + 1 for n in last.values())
        assert {c: n for (c, g), n in each.items() if g == gap} == {c: n + 1 for c, n in last.items()}
    assert len(total) == 8
    parts = [gap_spectrum(spark.createDataFrame([r for r in rows if r[1] is not None and r[1] % 2 == i], EVENTS), COLS) for i in range(2)]
    merged = merged_spectra(parts[0].unionByName(parts[1]), COLS)
    assert bag(merged, *merged.columns) == bag(spectrum, *merged.columns)
    none = gap_spectrum(spark.createDataFrame([], EVENTS), COLS)
    assert [tuple(r) for r in sessions_by_gap(none, [1]).collect()] == [(1.0, 0)]
    assert sessions_by_gap(none, [1], ["customer_id"]).count() == 0
    with pytest.raises(ValueError):
        sessions_by_gap(spectrum, [-1])


def test_two_hundred_lengths_take_one_window(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame(history(random.Random(1), 50, 0, 99), EVENTS).write.parquet(path)
    counts = sessions_by_gap(gap_spectrum(spark.read.parquet(path), COLS), range(200))
    counts.collect()
    plan = final_plan_of(counts)
    assert plan.count("Window [") == 1 and plan.count("FileScan") == 1


# --- medians --------------------------------------------------------------------------------------


def test_median_of_every_group(spark):
    rng = random.Random(10)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 2, 2, 3]), rng.choice("ab"), rng.choice([None, *range(-5, 40)])) for _ in range(900)]
    rows += [(50 + i, "a", i) for i in range(60)] + [(9, "a", None), (10, "a", -(2**60)), (10, "a", 2**60)]
    df = spark.createDataFrame(rows, "g long, h string, v long").withColumn("_start", F.lit(1))
    want = defaultdict(list)
    for g, h, v in rows:
        if v is not None:
            want[g, h].append(v)
    got = {(r.g, r.h): r.m for r in median_by(df, "v", ["g", "h"], "m").collect()}
    assert got == {k: float(median(v)) for k, v in want.items()}
    one = median_by(df.withColumn("all", F.lit(0)), "v", ["all"]).first()["median"]
    assert one == exact_median(df, "v").first()[0]
    assert median_by(df.limit(0), "v", ["g"]).count() == 0


def test_median_of_weighted_values(spark):
    rows = [(1, 5, 3), (1, 7, 1), (1, 9, 0), (1, 9, -1), (1, 9, 1), (2, 4, 2), (2, 6, 2), (3, 1, 0)]
    df = spark.createDataFrame(rows, "g long, v long, n long")
    assert {r.g: r["median"] for r in median_by(df, "v", ["g"], times="n").collect()} == {1: 5.0, 2: 5.0}


def test_sketch_is_within_its_bound(spark):
    rng = random.Random(11)
    rows = [(i % 4, "x" if rng.random() < 0.7 else None, int(rng.lognormvariate(5, 2))) for i in range(40_000)]
    rows += [(0, "y", None)]
    df = spark.createDataFrame(rows, "load long, g string, v long")
    loads = [sketch.sketch_values(df.filter(F.col("load") == i), "v", ["g"], 200) for i in range(4)]
    merged = sketch.merge_sketches(loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(loads[3]), ["g"], 200)
    told = sketch.sketch_median(merged, ["g"], "m", lambda v: v)
    ranks = {r.g: r for r in sketch.rank_range(df, "v", told, ["g"], "m").collect()}
    assert set(ranks) == {"x", None} and {r.g: r["values"] for r in merged.collect()} == {
        g: sum(r[1] == g and r[2] is not None for r in rows) for g in ("x", None)
    }
    bound = sketch.rank_error(200)
    assert 0.01 < bound < 0.02
    for r in ranks.values():
        assert r.rank_from <= 0.5 + bound and r.rank_to >= 0.5 - bound
    size = max(len(r.sketch) for r in merged.collect())
    assert size < 20_000
    assert sketch.sketch_values(df.limit(0), "v").count() == 0


# --- files in ranges ------------------------------------------------------------------------------


def test_views_of_clustered_files(spark, tmp_path):
    rng = random.Random(12)
    rows = [(i, rng.choice([None, *range(30)]), at(rng.choice([None, *range(500)])), "view") for i in range(800)]
    df, path = spark.createDataFrame(rows, EVENTS), str(tmp_path / "it's in order")
    order = ["customer_id", "timestamp", "event_id"]
    clustered.write_clustered(df, path, order, files=20)
    assert clustered.read_zones(spark, path).agg(F.sum("rows")).first()[0] == 800
    for side in ("top", "bottom"):
        for n in (0, 1, 5, 90, 900):
            got = clustered.view_clustered(spark, path, side, n)
            assert [tuple(r) for r in got.collect()] == [tuple(r) for r in sl.view(df, order, side, n).collect()]
        assert len(clustered.view_clustered(spark, path, side, 5).inputFiles()) <= 2
    clustered.write_clustered(df.limit(0), str(tmp_path / "none"), order)
    assert clustered.view_clustered(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        clustered.view_clustered(spark, path, "middle")


def test_times_stay_naive(spark):
    """A moment that a zone with daylight saving would bend."""
    rows = [(1, 1, dt.datetime(2023, 3, 26, 2, 30), "view"), (2, 1, dt.datetime(2023, 3, 26, 3, 30), "view")]
    standing = StandingMetrics(spark, work_folder(spark, "standing"), 90, cols=COLS)
    standing.add(spark.createDataFrame(rows[:1], EVENTS), "a")
    standing.add(spark.createDataFrame(rows[1:], EVENTS), "b")
    assert values(standing) == Counter({("session_diff", 0): 1, ("duration_micros", 3_600_000_000): 1})

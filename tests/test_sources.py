import datetime as dt
import json
import pathlib
import threading
from collections import Counter

import pytest
from helpers import bag
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sessionloom as sl
from sessionloom import SplitRule
from sessionloom.columns import RAW_SCHEMA, STAGED_SCHEMA, TABLE_SCHEMA, Columns
from sessionloom.functions import parse_timestamp
from sessionloom.session import work_folder
from sessionloom.sources import raw, staged, warehouse
from sessionloom.streaming import load as streaming

LINES = [
    {"type": "view", "event": {"customer-id": 7, "timestamp": "2023-01-01T10:00:00.5"}},
    {"type": "placed_order", "event": {"customer-id": 7, "timestamp": "2023-01-01T10:01:30.5"}},
    {"type": "view", "event": {"customer-id": None, "timestamp": "2023-01-01T10:00:00"}},
    {"type": "view", "event": None},
    {"type": "view", "event": {"customer-id": 8, "timestamp": "yesterday"}},
]


def write_lines(folder, lines):
    path = folder / "events.json"
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    return str(path)


def stage(spark, tmp_path, rule=SplitRule()):
    target = str(tmp_path / "staged")
    sl.run_etl(spark, write_lines(tmp_path, LINES), target, 30, rule=rule)
    return target


def test_timestamp_texts(spark):
    second = dt.datetime(2023, 1, 1, 10, 20, 30)
    cases = {
        "2023-01-01T10:20:30": second,
        "2023-01-01T10:20:30.1": second.replace(microsecond=100000),
        "2023-01-01T10:20:30.123456": second.replace(microsecond=123456),
        "2023-01-01T10:20:30.123456789": second.replace(microsecond=123456),
        "2023-01-01T10:20:30Z": None,
        "2023-01-01 10:20:30": None,
        "2023-02-30T10:20:30": None,
        "2023-01-01T10:20:30\n": None,
        " 2023-01-01T10:20:30": None,
        "2023-01-01T10:20": None,
        "garbage": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "text string")
    got = {r.text: r.ts for r in df.withColumn("ts", parse_timestamp(F.col("text"))).collect()}
    assert got == cases


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2023-03-26T02:30:00",)], "text string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # a time that is skipped there
    try:
        got = df.select(parse_timestamp(F.col("text"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2023, 3, 26, 2, 30)


def test_read_and_flatten(spark, tmp_path):
    events = raw.typed_events(raw.read_events_json(spark, write_lines(tmp_path, LINES)))
    assert events.columns == ["type", "customer_id", "timestamp"]
    assert bag(events, "customer_id", "type") == {(7, "view"): 1, (7, "placed_order"): 1, (8, "view"): 1}


TIME = "2023-01-01T10:00:00"
PLACES = {
    "inside": [{"event": {"customer-id": 1, "timestamp": TIME, "type": "view"}}],
    "top": [{"customer-id": 1, "timestamp": TIME, "type": "view", "event": {}}],
    "no struct": [{"customer-id": 1, "timestamp": TIME, "type": "view"}],
    "split": [{"customer-id": 1, "type": "view", "event": {"timestamp": TIME}}],
    "each in its own way": [
        {"customer-id": 1, "event": {"timestamp": TIME, "type": "view"}},
        {"type": "view", "timestamp": TIME, "event": {"customer-id": 2}},
    ],
}


@pytest.mark.parametrize("schema", [RAW_SCHEMA, None], ids=["given", "inferred"])
@pytest.mark.parametrize("case", PLACES)
def test_fields_in_any_place_go_through_the_job(spark, tmp_path, case, schema):
    if schema is None and not all(line.get("event") for line in PLACES[case]):
        pytest.skip("nothing to infer a struct from")
    source = write_lines(tmp_path, PLACES[case])
    rows = sl.run_etl(spark, source, str(tmp_path / "staged"), 30, schema=schema)
    assert rows.count() == len(PLACES[case])
    assert rows.filter("timestamp is null or type is null").isEmpty()


def test_the_value_at_the_top_comes_first(spark, tmp_path):
    lines = [{"type": "a", "customer-id": 1, "event": {"customer-id": 2, "timestamp": TIME, "type": "b"}}]
    events = raw.typed_events(raw.read_events_json(spark, write_lines(tmp_path, lines)))
    assert [(r.customer_id, r.type) for r in events.collect()] == [(1, "a")]


@pytest.mark.parametrize("gone", ["customer-id", "timestamp", "type"])
@pytest.mark.parametrize("rule", [SplitRule(), SplitRule(0, 1)])
def test_a_field_without_any_value_is_refused(spark, tmp_path, gone, rule):
    record = {"customer-id": 1, "timestamp": TIME, "type": "view"}
    lines = [{**{k: v for k, v in record.items() if k != gone}, "event": {}}] * 3
    target = tmp_path / "staged"
    with pytest.raises(ValueError, match=gone.split("-")[0]):
        sl.run_etl(spark, write_lines(tmp_path, lines), str(target), 30, rule=rule)
    assert not target.exists()


def test_no_records_are_no_error(spark, tmp_path):
    assert sl.run_etl(spark, write_lines(tmp_path, []), str(tmp_path / "staged"), 30).count() == 0


@pytest.mark.parametrize("rule", [SplitRule(), SplitRule(0, 1)])
def test_the_job_leaves_no_folders_behind(spark, tmp_path, rule):
    lines = [{"type": "view", "event": {"customer-id": 1, "timestamp": TIME}}] * 30
    before = work_folder(spark, "x").rsplit("/", 1)[0]
    names = lambda: sorted(p.name for p in pathlib.Path(before).glob("*"))
    had = names()
    sl.run_etl(spark, write_lines(tmp_path, lines), str(tmp_path / "staged"), 30, rule=rule)
    assert names() == had


def test_flatten_refuses_a_clash(spark):
    with pytest.raises(ValueError, match="customer_id"):
        raw.flatten(raw.empty_events(spark))
    with pytest.raises(TypeError):
        raw.flatten(raw.empty_events(spark), "type")


def test_empty_events(spark):
    empty = raw.empty_events(spark)
    assert empty.schema == RAW_SCHEMA and empty.count() == 0
    assert sl.sessionize(raw.typed_events(empty), 30).count() == 0


def test_bad_line_fails_or_is_kept(spark, tmp_path):
    path = write_lines(tmp_path, [LINES[0], "{bad json"])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        raw.read_events_json(spark, path).collect()
    rows = raw.read_events_json(spark, path, keep_bad_lines=True)
    assert [r[raw.BAD_LINE] for r in rows.collect() if r[raw.BAD_LINE]] == ["{bad json"]
    events = raw.typed_events(rows.drop(raw.BAD_LINE))
    assert events.count() == 1


@pytest.mark.parametrize("rule", [SplitRule(), SplitRule(0, 1)])
def test_etl_writes_the_staged_schema(spark, tmp_path, rule):
    target = stage(spark, tmp_path, rule)
    files = spark.read.parquet(target)
    assert [(f.name, f.dataType) for f in files.schema] == [
        (f.name, f.dataType) for f in STAGED_SCHEMA
    ]
    rows = staged.read_staged(spark, target)
    assert rows.columns == TABLE_SCHEMA.fieldNames()
    assert bag(rows, "customer_id", "time_diff", "session_number", "type") == {
        (7, 0.0, 0, "view"): 1,
        (7, 1.5, 0, "placed_order"): 1,
        (8, 0.0, 0, "view"): 1,
    }


def test_etl_equals_direct_sessionizing(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("type"),
    )
    source = work_folder(spark, "test-ndjson")
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    event = F.struct(F.col("customer_id").alias("customer-id"), text)
    events.select("type", event.alias("event")).write.json(source)
    rows = sl.run_etl(spark, source, work_folder(spark, "test-staged"), 480)
    assert bag(rows, *rows.columns) == bag(sl.sessionize(events, 480), *rows.columns)


def test_sample(spark, tmp_path):
    target = stage(spark, tmp_path)
    assert staged.sample_staged(spark, target, 2).count() == 2
    first = staged.sample_staged(spark, target, 1, ["customer_id", "timestamp"]).first()
    assert (first.customer_id, first.type) == (7, "view")


def test_load_cuts_minutes_and_can_be_repeated(spark, tmp_path):
    target = stage(spark, tmp_path)
    place = {"database": "shop_a", "location": str(tmp_path / "shop_a")}
    for _ in range(2):
        table = sl.run_load(spark, target, **place)
        assert table.count() == 3
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in TABLE_SCHEMA
    ]
    assert sorted(r.time_diff for r in table.collect()) == [0, 0, 1]
    assert tuple(sl.order_metrics(table).first()) == (0.0, 0.0)


def test_load_of_numbers_that_do_not_fit(spark, tmp_path):
    target = str(tmp_path / "wide")
    rows = sl.sessionize(
        spark.createDataFrame(
            [(2**40, dt.datetime(2023, 1, 1), "view"), (1, dt.datetime(2023, 1, 1), "view")],
            "customer_id long, timestamp timestamp_ntz, type string",
        ),
        30,
    )
    staged.write_staged(rows, target)
    place = {"database": "shop_b", "location": str(tmp_path / "shop_b")}
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        warehouse.load_events(spark, target, **place)
    rejected = warehouse.rejected_rows(staged.read_staged(spark, target))
    assert [r.customer_id for r in rejected.collect()] == [2**40]
    assert warehouse.load_events(spark, target, **place, skip_rejected=True).count() == 1


def renamed(spark, tmp_path, change=lambda df: df):
    """The staged rows in files whose columns have other names."""
    rows = staged.read_staged(spark, stage(spark, tmp_path))
    target = str(tmp_path / "renamed")
    change(rows.toDF(*[f"c{i}" for i in range(6)])).write.parquet(target)
    return target, rows


def test_load_goes_by_position(spark, tmp_path):
    target, rows = renamed(spark, tmp_path)
    place = {"database": "shop_f", "location": str(tmp_path / "shop_f")}
    assert bag(staged.read_staged(spark, target), *rows.columns) == bag(rows, *rows.columns)
    table = sl.run_load(spark, target, **place)
    assert table.filter("customer_id is null").isEmpty() and table.count() == 3
    options = dict(checkpoint=str(tmp_path / "ck"), available_now=True)
    streaming.stream_load(spark, target, **place, **options).awaitTermination()
    table = warehouse.scan_events(spark, "shop_f")
    assert table.filter("customer_id is null").isEmpty() and table.count() == 3


CHANGES = {
    "a column too few": (ValueError, lambda df: df.drop("c5")),
    "a column too many": (ValueError, lambda df: df.withColumn("c6", F.lit(1))),
    "text for a number": (TypeError, lambda df: df.withColumn("c0", F.col("c0").cast("string"))),
    "another order": (TypeError, lambda df: df.select("c5", "c0", "c1", "c2", "c3", "c4")),
}


@pytest.mark.parametrize("case", CHANGES)
def test_other_columns_are_refused(spark, tmp_path, case):
    error, change = CHANGES[case]
    target, _ = renamed(spark, tmp_path, change)
    place = {"database": "shop_g", "location": str(tmp_path / "shop_g")}
    with pytest.raises(error, match="column"):
        sl.run_load(spark, target, **place)
    with pytest.raises(error, match="column"):
        streaming.stream_load(spark, target, str(tmp_path / "ck"), **place, available_now=True)


def test_files_that_change_names_under_a_stream_are_refused(spark, tmp_path):
    place = {"database": "shop_h", "location": str(tmp_path / "shop_h")}
    target = str(tmp_path / "late")
    query = streaming.stream_load(spark, target, str(tmp_path / "ck"), **place)
    try:
        other, _ = renamed(spark, tmp_path)
        spark.read.parquet(other).write.parquet(target)
        with pytest.raises(Exception, match="other column names"):
            query.processAllAvailable()
    finally:
        query.stop()


def test_batch_and_stream_share_a_table(spark, tmp_path):
    place = {"database": "shop_i", "location": str(tmp_path / "shop_i")}
    first, second = stage(spark, tmp_path), str(tmp_path / "second")
    rows = staged.read_staged(spark, first)
    staged.write_staged(rows.withColumn("customer_id", F.col("customer_id") + 100), second)
    follow = dict(available_now=True, **place)

    def table():
        return Counter(r.customer_id for r in warehouse.scan_events(spark, "shop_i").collect())

    sl.run_load(spark, first, **place)
    streaming.stream_load(spark, second, str(tmp_path / "ck"), **follow).awaitTermination()
    assert table() == {7: 2, 8: 1, 107: 2, 108: 1}
    # The folder is staged again, with fewer rows: its rows are replaced, the other folder's stay.
    staged.write_staged(rows.filter("customer_id = 7"), second)
    streaming.stream_load(spark, second, str(tmp_path / "ck"), **follow).awaitTermination()
    assert table() == {7: 4, 8: 1}
    # A stream over the folder that batch has loaded takes over from it.
    streaming.stream_load(spark, first, str(tmp_path / "ck2"), **follow).awaitTermination()
    assert table() == {7: 4, 8: 1}
    # A batch load replaces everything, as documented, and can be repeated.
    for _ in range(2):
        sl.run_load(spark, first, **place)
        assert table() == {7: 2, 8: 1}


def test_a_batch_that_is_tried_again_replaces_itself(spark, tmp_path):
    target = stage(spark, tmp_path)
    name = warehouse.ensure_tables(spark, "shop_j", location=str(tmp_path / "shop_j"))
    rows = warehouse.as_table_rows(staged.read_staged(spark, target))
    for _ in range(2):
        warehouse.replace_load(rows, name, "stream-x-0-0")
    assert warehouse.scan_events(spark, "shop_j").count() == 3


def test_names_and_places_are_quoted(spark, tmp_path):
    place = tmp_path / "it's here"
    name = warehouse.ensure_tables(spark, "shop_k", "select", str(place))
    assert name == "`shop_k`.`select`" and warehouse.quoted("a`b") == "`a``b`"
    assert warehouse.scan_events(spark, "shop_k", "select").count() == 0


def test_load_waits_for_the_files(spark, tmp_path):
    place = {"database": "shop_l", "location": str(tmp_path / "shop_l")}
    target = str(tmp_path / "staged")
    with pytest.raises(TimeoutError, match="nothing was staged"):
        sl.run_load(spark, target, **place, wait=0.2)
    later = threading.Timer(1.0, lambda: stage(spark, tmp_path))
    later.start()
    assert sl.run_load(spark, target, **place, wait=60).count() == 3
    later.join()


def test_stream_loads_each_file_once(spark, tmp_path):
    target = stage(spark, tmp_path)
    place = {"database": "shop_c", "location": str(tmp_path / "shop_c")}
    options = dict(checkpoint=str(tmp_path / "ck"), available_now=True, max_files_per_trigger=1)

    def run():
        streaming.stream_load(spark, target, **place, **options).awaitTermination()
        return warehouse.scan_events(spark, "shop_c")

    batch = warehouse.as_table_rows(staged.read_staged(spark, target))
    once = run()
    assert bag(once, *once.columns) == bag(batch, *once.columns)
    assert run().count() == 3
    staged.as_staged(staged.read_staged(spark, target)).write.mode("append").parquet(target)
    spark.catalog.refreshTable("shop_c.events")
    assert run().count() == 6


def test_stream_waits_for_a_folder_that_is_not_there_yet(spark, tmp_path):
    place = {"database": "shop_d", "location": str(tmp_path / "shop_d")}
    options = dict(checkpoint=str(tmp_path / "ck"), available_now=True)
    target = str(tmp_path / "staged")
    streaming.stream_load(spark, target, **place, **options).awaitTermination()
    assert warehouse.scan_events(spark, "shop_d").count() == 0
    stage(spark, tmp_path)
    streaming.stream_load(spark, target, **place, **options).awaitTermination()
    assert warehouse.scan_events(spark, "shop_d").count() == 3


def test_stream_keeps_polling(spark, tmp_path):
    place = {"database": "shop_e", "location": str(tmp_path / "shop_e")}
    target = stage(spark, tmp_path)
    query = streaming.stream_load(spark, target, str(tmp_path / "ck"), **place)
    try:
        query.processAllAvailable()
        assert warehouse.scan_events(spark, "shop_e").count() == 3
    finally:
        query.stop()


def test_streamed_sessions_are_batch_sessions(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cols = Columns("user_id", "ts", "event_type")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.repartition(3).write.parquet(source)
    closed = streaming.stream_sessions(
        spark.readStream.schema(events.schema).parquet(source), 480, "40 days", cols
    )
    query = closed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
    # With so long a wait nothing is late and nothing is closed; a short one closes most sessions.
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.schema(closed.schema).parquet(out).count() == 0
    in_order, out = str(tmp_path / "sorted"), str(tmp_path / "out2")
    events.coalesce(1).write.parquet(in_order)
    closed = streaming.stream_sessions(
        spark.readStream.schema(events.schema).parquet(in_order), 480, "1 day", cols
    )
    query = closed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck2"))
    query.trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.schema(closed.schema).parquet(out)
    batch = (
        sl.sessionize(events, 480, cols)
        .groupBy("user_id", "session_number")
        .agg(
            F.min("ts").cast("timestamp").alias("session_start"),
            F.max("ts").cast("timestamp").alias("session_last"),
            F.count("*").alias("events"),
        )
    )
    names = ("user_id", "session_start", "session_last", "events")
    assert 0 < got.count() < batch.count()
    assert not bag(got, *names) - bag(batch, *names)


def test_rerun_of_a_table_with_the_added_columns(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2023, 1, 1, 10), "view"), (1, dt.datetime(2023, 1, 1, 12), "placed_order")],
        "customer_id long, timestamp timestamp_ntz, type string",
    )
    for rule in (SplitRule(), SplitRule(0, 1)):
        once = sl.session_columns(df, [30], rule=rule)
        assert sl.session_columns(once, [30], rule=rule).columns == once.columns
        numbered = sl.with_order_number(sl.sessionize(df, 30), rule=rule)
        again = sl.with_order_number(numbered, rule=rule)
        assert again.columns == numbered.columns
        assert bag(again, *again.columns) == bag(numbered, *numbered.columns)


def test_views(spark):
    df = spark.range(20).withColumnRenamed("id", "n")
    assert [r.n for r in sl.view(df, ["n"]).collect()] == [0, 1, 2, 3, 4]
    assert [r.n for r in sl.view(df, ["n"], "bottom", 3).collect()] == [17, 18, 19]
    with pytest.raises(ValueError):
        sl.view(df, ["n"], "middle")


def test_shared_folder_is_required_on_a_cluster(spark):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Elsewhere, "x")
    Elsewhere.sparkContext.master = "local[2]"
    first, second = work_folder(Elsewhere, "x"), work_folder(Elsewhere, "x")
    assert first != second and first.split("/")[:-1] == second.split("/")[:-1]
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

"""

The ``events`` table plays the web shop's event log: ``user_id`` is the customer, ``event_type`` the
type, ``purchase`` the order, and ``event_id`` breaks ties. It has neither ties nor missing values,
so three inputs are derived from it, each from the whole table:

* ``plain``  the table as it is
* ``ties``   timestamps cut to the hour
* ``nulls``  the customer missing in every 13th event, the timestamp in every 17th

A fourth input, ``orders``, is the table of that name: days instead of instants, so ties are natural,
and a fulfilled order (status F) counts as the order.

Queries named ``*_split`` run with a low limit for long histories, so that most customers take the
way meant for very active ones; the result must be the same.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from sessionloom.columns import STAGED_SCHEMA, Columns  # noqa: E402
from sessionloom.functions import order_flag, parse_timestamp  # noqa: E402
from sessionloom.operators import sessions as S  # noqa: E402
from sessionloom.operators import sketch  # noqa: E402
from sessionloom.operators.history import SplitRule  # noqa: E402
from sessionloom.operators.late import merge_late  # noqa: E402
from sessionloom.operators.median import median_by  # noqa: E402
from sessionloom.operators.orders import OrderHistory, with_order_flag  # noqa: E402
from sessionloom.operators.preview import view  # noqa: E402
from sessionloom.operators.spectrum import gap_spectrum, merged_spectra, sessions_by_gap  # noqa: E402
from sessionloom.plans import jobs, metrics  # noqa: E402
from sessionloom.plans.standing import StandingMetrics  # noqa: E402
from sessionloom.session import work_folder  # noqa: E402
from sessionloom.sources import clustered, drifting, raw, staged, warehouse  # noqa: E402
from sessionloom.streaming import load as streaming  # noqa: E402
from sessionloom.streaming import numbering  # noqa: E402

GAP = 480
METRICS_GAP = 720
GAPS = (30, 480, 720)
ORDER = {"plain": "purchase", "ties": "purchase", "nulls": "purchase", "orders": "F"}
ORDERS_GAP = 60 * 24 * 60
COLS = Columns(tie=("event_id",))
WHOLE = SplitRule()
SPLIT = SplitRule(hot_rows=60, slice_rows=20)
ORDERS_SPLIT = SplitRule(hot_rows=10, slice_rows=4)  # customers have fewer orders than events


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: sessionize the events and compute both order metrics."""
    return _order_metrics("plain")(spark, "/root/testdata/sf0.001")


# --- inputs -----------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str, kind: str = "plain") -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if kind == "orders":
        return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
            F.col("o_orderkey").alias("event_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("timestamp"),
            F.col("o_orderstatus").alias("type"),
        )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("type"),
    )
    ts, no = F.col("timestamp"), F.col("event_id")
    if kind == "ties":
        return events.withColumn("timestamp", F.date_trunc("hour", ts).cast("timestamp_ntz"))
    if kind == "nulls":
        return events.withColumns(
            {
                "customer_id": F.when(no % 13 != 0, F.col("customer_id")),
                "timestamp": F.when(no % 17 != 0, ts),
            }
        )
    return events


def _sessions(spark, sf_dir, kind="plain", gap=GAP, rule=WHOLE) -> DataFrame:
    gap = ORDERS_GAP if kind == "orders" else gap
    return S.sessionize(_events(spark, sf_dir, kind), gap, COLS, keep=["event_id"], rule=rule)


def _history(spark, sf_dir, kind="plain", gap=GAP, rule=WHOLE, keep=("event_id",)) -> OrderHistory:
    gap = ORDERS_GAP if kind == "orders" else gap
    events = _events(spark, sf_dir, kind)
    return OrderHistory.of_events(events, gap, ORDER[kind], COLS, keep=keep, rule=rule)


def _iso(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _raw_schema() -> T.StructType:
    event = T.StructType(
        [
            T.StructField("event-id", T.LongType()),
            T.StructField("customer-id", T.LongType()),
            T.StructField("timestamp", T.StringType()),
        ]
    )
    return T.StructType([T.StructField("type", T.StringType()), T.StructField("event", event)])


def _write_ndjson(spark, sf_dir, kind="plain", top=("type",)) -> str:
    """Nested records; ``top`` names the fields that stand outside the struct."""
    path = work_folder(spark, "ndjson")
    fields = {
        "event-id": F.col("event_id"),
        "customer-id": F.col("customer_id"),
        "timestamp": _iso("timestamp"),
        "type": F.col("type"),
    }
    outside = [fields[n].alias(n) for n in fields if n in top]
    event = F.struct(*[fields[n].alias(n) for n in fields if n not in top])
    _events(spark, sf_dir, kind).select(*outside, event.alias("event")).write.json(path)
    return path


def _stage(spark, sf_dir, kind="plain") -> str:
    path = work_folder(spark, "staged")
    staged.write_staged(_sessions(spark, sf_dir, kind), path)
    return path


def _own_database(spark) -> dict[str, str]:
    location = work_folder(spark, "database")
    return {"database": "webshop_" + location[-32:], "location": location}


# --- training-data operators --------------------------------------------------------------------

LLM_MODULES = ("sessionloom.llm", "sessionloom.llm.queries", "corpus_pipeline")


def _llm(part: str) -> dict:
    """``queries`` or ``oracle_sql`` of the subpackage for training data; nothing if it is not there."""
    try:
        import corpus_pipeline
        from sessionloom.llm import queries as llm
    except ImportError as missing:
        if missing.name not in LLM_MODULES:
            raise
        return {}
    found = dict(getattr(llm, part)())
    if part == "queries":
        found["pipeline"] = corpus_pipeline.run
    elif corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


# --- queries ----------------------------------------------------------------------------------


def _ndjson_ingest(spark, sf_dir):
    read = raw.read_events_json(spark, _write_ndjson(spark, sf_dir, "nulls"), _raw_schema())
    return raw.typed_events(read)


def _ndjson_job(top: tuple[str, ...]):
    """The whole job on records whose fields stand in other places."""

    def run(spark, sf_dir):
        source = _write_ndjson(spark, sf_dir, "nulls", top)
        return jobs.run_etl(spark, source, work_folder(spark, "staged"), GAP)

    return run


def _unnest_event(spark, sf_dir):
    return raw.flatten(raw.read_events_json(spark, _write_ndjson(spark, sf_dir), _raw_schema()))


def _parse_timestamp(spark, sf_dir):
    # Each event's time in one of six spellings, three of which are not accepted.
    kind = F.col("event_id") % 6
    text = (
        F.when(kind == 0, _iso("timestamp"))
        .when(kind == 1, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.concat(_iso("timestamp"), F.lit("789")))
        .when(kind == 3, F.concat(_iso("timestamp"), F.lit("Z")))
        .when(kind == 4, F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.date_format("timestamp", "yyyy"), F.lit("-02-30T10:00:00")))
    )
    events = _events(spark, sf_dir)
    return events.select("event_id", parse_timestamp(text).alias("timestamp"))


def _step(*names: str, kind: str = "plain", rule: SplitRule = WHOLE):
    """One of the columns on the way to sessions, for every event."""

    def run(spark, sf_dir):
        out = S.session_columns(_events(spark, sf_dir, kind), [GAP], COLS, rule=rule)
        out = out.withColumnsRenamed(
            {"new_session_0": "new_session", "session_number_0": "session_number"}
        )
        return out.select("event_id", "customer_id", "timestamp", *names)

    return run


def _sessionize(kind: str, rule: SplitRule = WHOLE):
    return lambda spark, sf_dir: _sessions(spark, sf_dir, kind, rule=rule)


def _resessionize(rule: SplitRule = WHOLE):
    def run(spark, sf_dir):
        first = _sessions(spark, sf_dir, rule=rule)
        return S.resessionize(first, GAPS, COLS, keep=["event_id"], rule=rule)

    return run


def _ordered(step, kind: str = "plain", rule: SplitRule = WHOLE):
    return lambda spark, sf_dir: step(_history(spark, sf_dir, kind, rule=rule))


def _order_metrics(kind: str, rule: SplitRule = WHOLE, metric=metrics.metrics_of):
    def run(spark, sf_dir):
        return metric(_history(spark, sf_dir, kind, METRICS_GAP, rule, keep=()))

    return run


def _staged_roundtrip(spark, sf_dir):
    target = work_folder(spark, "staged")
    return jobs.run_etl(spark, _write_ndjson(spark, sf_dir), target, GAP)


def _load_events(spark, sf_dir):
    return jobs.run_load(spark, _stage(spark, sf_dir), **_own_database(spark))


def _load_renamed(spark, sf_dir):
    """Staged under other column names, which the load must not care about."""
    path = work_folder(spark, "staged")
    rows = staged.read_staged(spark, _stage(spark, sf_dir))
    rows.toDF(*[f"column_{i}" for i in range(len(rows.columns))]).write.parquet(path)
    return jobs.run_load(spark, path, **_own_database(spark))


def _followed(spark, path, place, checkpoint):
    load = streaming.stream_load(spark, path, checkpoint, **place, available_now=True)
    load.awaitTermination()


def _batch_then_stream(spark, sf_dir):
    """One half of the customers loaded in batch, the other by a stream, into one table."""
    place, halves = _own_database(spark), []
    for half in range(2):
        rows = _sessions(spark, sf_dir).filter(F.col("customer_id") % 2 == half)
        halves.append(work_folder(spark, "staged"))
        staged.write_staged(rows, halves[-1])
    jobs.run_load(spark, halves[0], **place)
    _followed(spark, halves[1], place, work_folder(spark, "stream"))
    return warehouse.scan_events(spark, place["database"])


def _stream_reload(spark, sf_dir):
    """ETL and stream twice, into the same folder: the rows are there once."""
    place, path = _own_database(spark), work_folder(spark, "staged")
    checkpoint = work_folder(spark, "stream")
    for _ in range(2):
        staged.write_staged(_sessions(spark, sf_dir), path)
        _followed(spark, path, place, checkpoint)
    return warehouse.scan_events(spark, place["database"])


def _stream_load(spark, sf_dir):
    path, place = _stage(spark, sf_dir), _own_database(spark)
    checkpoint = work_folder(spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        load = streaming.stream_load(spark, path, checkpoint, **place, available_now=True)
        load.awaitTermination()
    return warehouse.scan_events(spark, place["database"])


def _stream_sessions(spark, sf_dir):
    events = spark.readStream.schema(STAGED_SCHEMA).parquet(_stage(spark, sf_dir))
    events = raw.flatten_names(events)
    closed = streaming.stream_sessions(events, GAP, "1 day", COLS)
    out = work_folder(spark, "stream")
    query = (
        closed.writeStream.format("parquet")
        .option("checkpointLocation", out + "-checkpoint")
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    rows = spark.read.parquet(out)
    return rows.select(
        "customer_id",
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_last").cast("timestamp_ntz").alias("session_last"),
        "events",
    )


def _view(side: str):
    def run(spark, sf_dir):
        return view(_sessions(spark, sf_dir), ["customer_id", "timestamp", "event_id"], side)

    return run


def _thirds(events: DataFrame) -> list[DataFrame]:
    """The events in three parts by time; those without a time are in the first."""
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    low, high = events.select(F.percentile_approx(at, [0.33, 0.66]).alias("q")).first().q
    return [
        events.filter(at.isNull() | (at < low)),
        events.filter((at >= low) & (at < high)),
        events.filter(at >= high),
    ]


def _stream_session_numbers(kind: str):
    """The events arrive in three parts; the stream is started anew for each."""

    def run(spark, sf_dir):
        source, out = work_folder(spark, "arriving"), work_folder(spark, "stream")
        store = spark.conf.get(numbering.STATE_STORE)
        numbering.use_rocks_db(spark)
        try:
            for part in _thirds(_events(spark, sf_dir, kind)):
                part.write.mode("append").parquet(source)
                events = spark.readStream.schema(part.schema).parquet(source)
                rows = numbering.stream_session_numbers(events, GAP, COLS, keep=["event_id"])
                query = (
                    rows.writeStream.format("parquet")
                    .option("checkpointLocation", out + "-checkpoint")
                    .trigger(availableNow=True)
                    .start(out)
                )
                query.awaitTermination()
        finally:
            spark.conf.set(numbering.STATE_STORE, store)
        return spark.read.parquet(out).filter(~F.col("late")).drop("late")

    return run


def _metrics_after_loads(kind: str):
    """Three loads in order of time; each is added to what the ones before have left."""

    def run(spark, sf_dir):
        rule = {"gap_minutes": METRICS_GAP, "order_type": ORDER[kind], "cols": COLS}
        standing = StandingMetrics(spark, work_folder(spark, "standing"), **rule)
        for i, part in enumerate(_thirds(_events(spark, sf_dir, kind))):
            standing.add(part, f"load {i}")
        return standing.metrics()

    return run


def _metrics_after_late_load(spark, sf_dir):
    """A last load with events from all times, so that the customers it touches are worked out anew."""
    events = _events(spark, sf_dir)
    late = (F.col("customer_id") % 3 == 0) & (F.col("event_id") % 5 == 0)
    rule = {"gap_minutes": METRICS_GAP, "order_type": ORDER["plain"], "cols": COLS}
    standing = StandingMetrics(spark, work_folder(spark, "standing"), **rule)
    standing.add(events.filter(~late), "in order")
    standing.add(events.filter(late), "late", history=events.filter(~late))
    return standing.metrics()


def _late_events(kind: str):
    """A tenth of the events comes late."""

    def run(spark, sf_dir):
        late, events = F.col("event_id") % 10 == 3, _events(spark, sf_dir, kind)
        first = S.sessionize(events.filter(~late), GAP, COLS, keep=["event_id"])
        return merge_late(first, events.filter(late), GAP, COLS, keep=["event_id"]).events()

    return run


SPECTRUM_GAPS = tuple(range(0, 6000, 30))


def _session_counts_by_gap(spark, sf_dir):
    """Two hundred lengths from one spectrum, put together from those of two halves of the customers."""
    events = _events(spark, sf_dir)
    halves = [gap_spectrum(events.filter(F.col("customer_id") % 2 == i), COLS) for i in range(2)]
    return sessions_by_gap(merged_spectra(halves[0].unionByName(halves[1]), COLS), SPECTRUM_GAPS)


def _customer_sessions_by_gap(spark, sf_dir):
    spectrum = gap_spectrum(_events(spark, sf_dir, "nulls"), COLS, rule=SPLIT)
    return sessions_by_gap(spectrum, (*GAPS, 2880), ["customer_id"])


def _median_by_customer(spark, sf_dir):
    """The median pause of every customer, in microseconds."""
    spectrum = gap_spectrum(_events(spark, sf_dir, "ties"), COLS)
    return median_by(spectrum, "pause_micros", ["customer_id"], "median_pause", times="pauses")


def _sketch_medians(spark, sf_dir):
    """Sketches of three loads, merged: whether their medians are within the bound on the rank error."""
    figures = _history(spark, sf_dir, gap=METRICS_GAP, keep=()).figures().withColumn(
        "load", F.pmod(F.xxhash64("figure", "value"), F.lit(3))
    )
    sketches = sketch.sketch_values(figures, "value", ["figure", "load"])
    told = sketch.sketch_median(sketch.merge_sketches(sketches, ["figure"]), ["figure"], "median", lambda v: v)
    ranks = sketch.rank_range(figures, "value", told, ["figure"], "median")
    near = (F.col("rank_from") <= 0.5 + sketch.rank_error()) & (F.col("rank_to") >= 0.5 - sketch.rank_error())
    return ranks.select("figure", "values", near.alias("within_bound"))


def _view_clustered(side: str):
    def run(spark, sf_dir):
        path = work_folder(spark, "clustered")
        clustered.write_clustered(_sessions(spark, sf_dir), path, ["customer_id", "timestamp", "event_id"])
        return clustered.view_clustered(spark, path, side)

    return run


def _drifting_lines(spark, sf_dir) -> DataFrame:
    """The events as records of several producers: some say the customer as text, some the time as a number,
    some have their fields at the top, some a field more, and some lines are cut off."""
    no = F.col("event_id")
    customer = F.when(no % 7 == 0, F.concat(F.lit('"'), "customer_id", F.lit('"'))).otherwise(
        F.col("customer_id").cast("string")
    )
    time = F.when(no % 13 == 0, F.unix_micros(F.col("timestamp").cast("timestamp")).cast("string")).otherwise(
        F.concat(F.lit('"'), _iso("timestamp"), F.lit('"'))
    )
    fields = F.concat(
        F.lit('"customer-id":'), customer, F.lit(',"timestamp":'), time, F.lit(',"type":"'), "type", F.lit('"')
    )
    head = F.concat(F.lit('{"event-id":'), no, F.when(no % 17 == 0, ',"note":true').otherwise(""), F.lit(","))
    line = (
        F.when(no % 11 == 0, head)
        .when(no % 5 == 0, F.concat(head, fields, F.lit("}")))
        .otherwise(F.concat(head, F.lit('"event":{'), fields, F.lit("}}")))
    )
    path = work_folder(spark, "lines")
    _events(spark, sf_dir).select(line.alias("value")).write.text(path)
    return drifting.read_lines(spark, path)


def _sifted(part: str):
    def run(spark, sf_dir):
        return getattr(drifting.sift(_drifting_lines(spark, sf_dir), cols=COLS, keep={"event-id": "long"}), part)

    return run


def _number(history: OrderHistory) -> DataFrame:
    return history.events().select("event_id", "customer_id", "timestamp", "order_number")


def _last_session(history: OrderHistory) -> DataFrame:
    return history.with_last_session().select(
        "event_id", "customer_id", "order_number", "max_session_for_order"
    )


def _before_first(history: OrderHistory) -> DataFrame:
    return history.before_first_order().select(
        "event_id", "customer_id", "timestamp", "session_number", "type"
    )


def _bounds(history: OrderHistory) -> DataFrame:
    return history.with_session_bounds().select(
        "event_id", "customer_id", "session_number", "min_session_event", "max_session_event"
    )


def _durations(history: OrderHistory) -> DataFrame:
    return history.durations().select("customer_id", "session_number", "session_duration")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, sf_dir) and gives a DataFrame."""
    q = {
        "scan_events": _events,
        "ndjson_ingest": _ndjson_ingest,
        "ndjson_ingest_inside": _ndjson_job(()),
        "ndjson_ingest_top": _ndjson_job(("customer-id", "timestamp", "type")),
        "one_customer": lambda s, d: S.one_customer(_events(s, d), 7, COLS),
        "unnest_event": _unnest_event,
        "known_customers": lambda s, d: S.known_customers(_events(s, d, "nulls"), COLS),
        "parse_timestamp": _parse_timestamp,
        "sort_events": lambda s, d: S.sort_events(_events(s, d, "nulls"), COLS),
        "prev_timestamp": _step("prev_timestamp"),
        "time_diff": _step("time_diff"),
        "new_session": _step("new_session"),
        "session_number": _step("session_number"),
        "prev_timestamp_split": _step("prev_timestamp", kind="nulls", rule=SPLIT),
        "resessionize": _resessionize(),
        "resessionize_split": _resessionize(SPLIT),
        "scan_staged": lambda s, d: staged.read_staged(s, _stage(s, d)),
        "stage_sample": lambda s, d: staged.sample_staged(
            s, _stage(s, d), order_by=["customer_id", "timestamp"]
        ),
        "staged_roundtrip": _staged_roundtrip,
        "load_events": _load_events,
        "load_renamed": _load_renamed,
        "batch_then_stream": _batch_then_stream,
        "stream_reload": _stream_reload,
        "stream_load": _stream_load,
        "stream_sessions": _stream_sessions,
        "order_flag": lambda s, d: with_order_flag(_events(s, d), ORDER["plain"], COLS),
        "order_flag_count": lambda s, d: _events(s, d).agg(
            F.sum(order_flag(F.col("type"), ORDER["plain"])).alias("orders")
        ),
        "view_top": _view("top"),
        "view_bottom": _view("bottom"),
        "order_metrics_json": _order_metrics("plain", metric=metrics.metrics_json_of),
        "stream_session_numbers": _stream_session_numbers("plain"),
        "stream_session_numbers_nulls": _stream_session_numbers("nulls"),
        "metrics_after_loads": _metrics_after_loads("plain"),
        "metrics_after_loads_ties": _metrics_after_loads("ties"),
        "metrics_after_loads_nulls": _metrics_after_loads("nulls"),
        "metrics_after_late_load": _metrics_after_late_load,
        "late_events": _late_events("plain"),
        "late_events_nulls": _late_events("nulls"),
        "session_counts_by_gap": _session_counts_by_gap,
        "customer_sessions_by_gap": _customer_sessions_by_gap,
        "median_by_customer": _median_by_customer,
        "sketch_medians": _sketch_medians,
        "field_profile": lambda s, d: drifting.field_profile(_drifting_lines(s, d)),
        "drifting_ingest": _sifted("events"),
        "drifting_aside": lambda s, d: _sifted("aside")(s, d).groupBy("reason").agg(
            F.count(F.lit(1)).alias("lines")
        ),
        "clustered_top": _view_clustered("top"),
        "clustered_bottom": _view_clustered("bottom"),
    }
    steps = {
        "order_number": _number,
        "max_session_per_order": _last_session,
        "distinct_session_orders": OrderHistory.groups,
        "lag_max_session": OrderHistory.lagged,
        "session_diff": OrderHistory.diffs,
        "before_first_order": _before_first,
        "session_bounds": _bounds,
        "session_duration": _durations,
    }
    figures = {
        "order_metrics": metrics.metrics_of,
        "median_visits_before_order": metrics.median_visits_of,
        "median_session_duration_before_order": metrics.median_duration_of,
    }
    for kind in ORDER:
        suffix = "" if kind == "plain" else f"_{kind}"
        split = ORDERS_SPLIT if kind == "orders" else SPLIT
        for rule, end in ((WHOLE, suffix), (split, suffix + "_split")):
            q["sessionize" + end] = _sessionize(kind, rule)
            for name, step in steps.items():
                q[name + end] = _ordered(step, kind, rule)
            for name, metric in figures.items():
                q[name + end] = _order_metrics(kind, rule, metric)
    return q | _llm("queries")


# --- SQL --------------------------------------------------------------------------------------

_INPUT_SQL = {
    "plain": """SELECT event_id, user_id AS customer_id, ts AS "timestamp", event_type AS "type"
        FROM events""",
    "ties": """SELECT event_id, user_id AS customer_id,
        CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", event_type AS "type"
        FROM events""",
    "orders": """SELECT o_orderkey AS event_id, o_custkey AS customer_id,
        CAST(o_orderdate AS TIMESTAMP) AS "timestamp", o_orderstatus AS "type"
        FROM orders""",
    "nulls": """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN user_id END AS customer_id,
        CASE WHEN event_id % 17 <> 0 THEN ts END AS "timestamp", event_type AS "type"
        FROM events""",
}


def _sql(tail: str, kind: str = "plain", gap: int = GAP) -> str:
    """Tables of instants, openings and placements, compared with each other, and the query on them.

    Nothing here walks through events one after the other: what came before is looked up, and numbers
    are counts of what is not later.
    """
    gap = ORDERS_GAP if kind == "orders" else gap
    return f"""
WITH ev AS ({_INPUT_SQL[kind]}),
known AS (SELECT * FROM ev WHERE customer_id IS NOT NULL),
instants AS (
    SELECT customer_id, "timestamp" AS at, min(event_id) AS opener,
        count(*) FILTER ("type" = '{ORDER[kind]}') AS placements
    FROM known WHERE "timestamp" IS NOT NULL GROUP BY customer_id, "timestamp"),
pauses AS (
    SELECT a.customer_id, a.at, any_value(a.opener) AS opener, max(b.at) AS earlier,
        coalesce(CAST(date_diff('microsecond', max(b.at), a.at) AS DOUBLE) / 6e7, 0e0) AS minutes
    FROM instants a LEFT JOIN instants b ON b.customer_id = a.customer_id AND b.at < a.at
    GROUP BY a.customer_id, a.at),
visits AS (
    SELECT a.customer_id, a.at, any_value(a.opener) AS opener, any_value(a.earlier) AS earlier,
        any_value(a.minutes) AS minutes, count(b.at) AS visit
    FROM pauses a LEFT JOIN pauses b
        ON b.customer_id = a.customer_id AND b.at <= a.at AND b.minutes > {gap}
    GROUP BY a.customer_id, a.at),
sessions AS (
    SELECT k.event_id, k.customer_id, k."timestamp", k."type",
        CASE WHEN k.event_id = v.opener THEN v.earlier ELSE v.at END AS prev_timestamp,
        CASE WHEN k.event_id = v.opener THEN v.minutes ELSE 0e0 END AS time_diff,
        CAST(k.event_id = v.opener AND v.minutes > {gap} AND v.at IS NOT NULL AS INTEGER)
            AS new_session,
        coalesce(v.visit, 0) AS session_number
    FROM known k LEFT JOIN visits v ON v.customer_id = k.customer_id AND v.at = k."timestamp"),
ordered AS (
    SELECT s.*, CAST(coalesce("type" = '{ORDER[kind]}', false) AS INTEGER) AS placed_order,
        CAST(coalesce((SELECT sum(i.placements) FROM instants i
            WHERE i.customer_id = s.customer_id AND i.at <= s."timestamp"), 0) AS BIGINT) AS timed,
        (SELECT count(*) FROM known k
            WHERE k.customer_id = s.customer_id AND k."type" = '{ORDER[kind]}') AS placed
    FROM sessions s),
events_by_order AS (
    SELECT * EXCLUDE (timed, placed),
        CASE WHEN "timestamp" IS NULL THEN placed ELSE timed END AS order_number FROM ordered),
reached AS (
    SELECT customer_id, order_number, max(session_number) AS max_session_for_order
    FROM events_by_order GROUP BY customer_id, order_number),
steps AS (
    SELECT r.customer_id, r.order_number, r.max_session_for_order,
        coalesce(arg_max(q.max_session_for_order, q.order_number), 0) AS lagged_max_session_order
    FROM reached r LEFT JOIN reached q
        ON q.customer_id = r.customer_id AND q.order_number < r.order_number
    GROUP BY r.customer_id, r.order_number, r.max_session_for_order),
unordered AS (SELECT * FROM events_by_order WHERE order_number = 0),
spells AS (
    SELECT customer_id, session_number, min("timestamp") AS began, max("timestamp") AS ended
    FROM unordered GROUP BY customer_id, session_number)
{tail}
"""


_STAGED_COLUMNS = 'customer_id, "timestamp", time_diff, new_session, session_number, "type"'
_TABLE_SQL = """SELECT CAST(customer_id AS INTEGER) AS customer_id, "timestamp",
    CAST(trunc(time_diff) AS INTEGER) AS time_diff, new_session,
    CAST(session_number AS INTEGER) AS session_number, "type" FROM sessions"""
_STEP = "max_session_for_order - lagged_max_session_order"
_LENGTH = "CAST(date_diff('microsecond', began, ended) AS DOUBLE) / 1e6 / 6e1"
_VISITS_SQL = f"(SELECT CAST(median({_STEP}) AS DOUBLE) FROM steps)"
_DURATION_SQL = f"(SELECT median({_LENGTH}) FROM spells)"
_STEP_SQL = {
    "sessionize": f"SELECT event_id, {_STAGED_COLUMNS} FROM sessions",
    "order_number": """SELECT event_id, customer_id, "timestamp", order_number
        FROM events_by_order""",
    "max_session_per_order": """SELECT event_id, customer_id, order_number, max_session_for_order
        FROM events_by_order JOIN reached USING (customer_id, order_number)""",
    "distinct_session_orders": "SELECT * FROM reached",
    "lag_max_session": "SELECT * FROM steps",
    "session_diff": f"SELECT *, {_STEP} AS session_diff FROM steps",
    "before_first_order": """SELECT event_id, customer_id, "timestamp", session_number, "type"
        FROM unordered""",
    "session_bounds": """SELECT event_id, customer_id, session_number, began AS min_session_event,
        ended AS max_session_event FROM unordered JOIN spells USING (customer_id, session_number)""",
    "session_duration": f"""SELECT customer_id, session_number, {_LENGTH} AS session_duration
        FROM spells""",
}
_FIGURE_SQL = {
    "order_metrics": f"""SELECT {_VISITS_SQL} AS {metrics.VISITS},
        {_DURATION_SQL} AS {metrics.DURATION}""",
    "median_visits_before_order": f"SELECT {_VISITS_SQL} AS {metrics.VISITS}",
    "median_session_duration_before_order": f"SELECT {_DURATION_SQL} AS {metrics.DURATION}",
}


def _step_sql(*names: str, kind: str = "plain") -> str:
    return _sql(f"""SELECT event_id, customer_id, "timestamp", {", ".join(names)} FROM sessions""", kind)


def _view_sql(direction: str) -> str:
    nulls = "NULLS FIRST" if direction == "ASC" else "NULLS LAST"
    order = ", ".join(f"{c} {direction} {nulls}" for c in ("customer_id", '"timestamp"', "event_id"))
    return _sql(f"SELECT event_id, {_STAGED_COLUMNS} FROM sessions ORDER BY {order} LIMIT 5")


def _resessionize_sql() -> str:
    """Each length on its own, put together."""
    columns = f"event_id, {_STAGED_COLUMNS}"
    parts = [
        f"SELECT {gap}e0 AS gap_minutes, {columns} FROM ({_sql('SELECT * FROM sessions', gap=gap)})"
        for gap in GAPS
    ]
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    """For each query the SQL that gives the same rows on the same tables."""
    sql = {
        "scan_events": _INPUT_SQL["plain"],
        "ndjson_ingest": _sql(
            'SELECT "type", event_id, customer_id, "timestamp" FROM ev WHERE customer_id IS NOT NULL',
            "nulls",
        ),
        "ndjson_ingest_inside": _sql(f"SELECT {_STAGED_COLUMNS} FROM sessions", "nulls"),
        "ndjson_ingest_top": _sql(f"SELECT {_STAGED_COLUMNS} FROM sessions", "nulls"),
        "one_customer": _sql("SELECT * FROM ev WHERE customer_id = 7"),
        "unnest_event": _sql(
            """SELECT "type", event_id, customer_id,
            strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp" FROM ev"""
        ),
        "known_customers": _sql("SELECT * FROM ev WHERE customer_id IS NOT NULL", "nulls"),
        "parse_timestamp": _sql(
            """SELECT event_id, CASE event_id % 6 WHEN 0 THEN "timestamp"
            WHEN 1 THEN CAST(date_trunc('second', "timestamp") AS TIMESTAMP)
            WHEN 2 THEN "timestamp" END AS "timestamp" FROM ev"""
        ),
        "sort_events": _sql(
            'SELECT * FROM ev ORDER BY customer_id NULLS FIRST, "timestamp" NULLS FIRST, event_id',
            "nulls",
        ),
        "prev_timestamp": _step_sql("prev_timestamp"),
        "time_diff": _step_sql("time_diff"),
        "new_session": _step_sql("new_session"),
        "session_number": _step_sql("session_number"),
        "prev_timestamp_split": _step_sql("prev_timestamp", kind="nulls"),
        "resessionize": _resessionize_sql(),
        "resessionize_split": _resessionize_sql(),
        "scan_staged": _sql(f"SELECT {_STAGED_COLUMNS} FROM sessions"),
        "stage_sample": _sql(
            f"""SELECT {_STAGED_COLUMNS} FROM sessions
            ORDER BY customer_id NULLS FIRST, "timestamp" NULLS FIRST LIMIT 10"""
        ),
        "staged_roundtrip": _sql(f"SELECT {_STAGED_COLUMNS} FROM sessions"),
        "load_events": _sql(_TABLE_SQL),
        "load_renamed": _sql(_TABLE_SQL),
        "batch_then_stream": _sql(_TABLE_SQL),
        "stream_reload": _sql(_TABLE_SQL),
        "stream_load": _sql(_TABLE_SQL),
        "stream_sessions": _sql(
            f"""SELECT customer_id, min("timestamp") AS session_start,
            max("timestamp") AS session_last, count(*) AS events
            FROM sessions GROUP BY customer_id, session_number
            HAVING max("timestamp") + INTERVAL {GAP} MINUTE
                <= (SELECT max("timestamp") FROM sessions) - INTERVAL 1 DAY"""
        ),
        "order_flag": _sql(
            f"""SELECT event_id, customer_id, "timestamp", "type",
            CAST(CASE WHEN "type" = '{ORDER["plain"]}' THEN 1 ELSE 0 END AS INTEGER)
            AS placed_order FROM ev"""
        ),
        "order_flag_count": f"""SELECT CAST(count(*) FILTER (event_type = '{ORDER["plain"]}') AS BIGINT)
            AS orders FROM events""",
        "view_top": _view_sql("ASC"),
        "view_bottom": _view_sql("DESC"),
        "stream_session_numbers": _sql(_STEP_SQL["sessionize"]),
        "stream_session_numbers_nulls": _sql(_STEP_SQL["sessionize"], "nulls"),
        "metrics_after_loads": _sql(_FIGURE_SQL["order_metrics"], gap=METRICS_GAP),
        "metrics_after_loads_ties": _sql(_FIGURE_SQL["order_metrics"], "ties", METRICS_GAP),
        "metrics_after_loads_nulls": _sql(_FIGURE_SQL["order_metrics"], "nulls", METRICS_GAP),
        "metrics_after_late_load": _sql(_FIGURE_SQL["order_metrics"], gap=METRICS_GAP),
        "late_events": _sql(_STEP_SQL["sessionize"]),
        "late_events_nulls": _sql(_STEP_SQL["sessionize"], "nulls"),
        "session_counts_by_gap": _sql(
            f"""SELECT CAST(g AS DOUBLE) AS gap_minutes, (SELECT count(DISTINCT customer_id) FROM known)
            + (SELECT count(*) FROM pauses p WHERE p.minutes > g) AS sessions
            FROM range({SPECTRUM_GAPS[0]}, {SPECTRUM_GAPS[-1] + 1}, 30) AS t(g)"""
        ),
        "customer_sessions_by_gap": _sql(
            f"""SELECT c.customer_id, CAST(g AS DOUBLE) AS gap_minutes, 1 + count(p.at) AS sessions
            FROM (SELECT DISTINCT customer_id FROM known) c
            CROSS JOIN (SELECT unnest([{", ".join(map(str, (*GAPS, 2880)))}]) AS g)
            LEFT JOIN pauses p ON p.customer_id = c.customer_id AND p.minutes > g
            GROUP BY c.customer_id, g""",
            "nulls",
        ),
        "median_by_customer": _sql(
            """SELECT customer_id, median(date_diff('microsecond', p.earlier, p.at)) AS median_pause
            FROM pauses p WHERE p.earlier IS NOT NULL GROUP BY customer_id""",
            "ties",
        ),
        "sketch_medians": _sql(
            """SELECT 'session_diff' AS figure, count(*) AS "values", true AS within_bound FROM steps
            UNION ALL SELECT 'duration_micros', count(*), true FROM spells WHERE began IS NOT NULL""",
            gap=METRICS_GAP,
        ),
        "field_profile": _sql(
            """SELECT place, field, kind, count(*) AS records FROM (
            SELECT CASE WHEN f IN ('event-id', 'note', 'event') OR event_id % 5 = 0 THEN 'top' ELSE 'inside' END
                AS place, f AS field, CASE WHEN f = 'event-id' THEN 'number' WHEN f = 'note' THEN 'flag'
                WHEN f = 'event' THEN 'struct'
                WHEN f = 'customer-id' AND event_id % 7 <> 0 THEN 'number'
                WHEN f = 'timestamp' AND event_id % 13 = 0 THEN 'number' ELSE 'text' END AS kind
            FROM ev CROSS JOIN (
                SELECT unnest(['event-id', 'note', 'event', 'customer-id', 'timestamp', 'type']) AS f)
            WHERE event_id % 11 <> 0 AND (f <> 'note' OR event_id % 17 = 0)
                AND (f <> 'event' OR event_id % 5 <> 0)
            UNION ALL SELECT NULL, NULL, 'no record' FROM ev WHERE event_id % 11 = 0)
            GROUP BY place, field, kind"""
        ),
        "drifting_ingest": _sql(
            """SELECT event_id, customer_id, "timestamp", "type" FROM ev
            WHERE event_id % 11 <> 0 AND event_id % 7 <> 0 AND event_id % 13 <> 0"""
        ),
        "drifting_aside": _sql(
            """SELECT CASE WHEN event_id % 11 = 0 THEN 'no JSON object' WHEN event_id % 7 = 0
                THEN 'the customer is no whole number' ELSE 'the timestamp is no time' END AS reason,
                count(*) AS lines
            FROM ev WHERE event_id % 11 = 0 OR event_id % 7 = 0 OR event_id % 13 = 0 GROUP BY reason"""
        ),
        "clustered_top": _view_sql("ASC"),
        "clustered_bottom": _view_sql("DESC"),
        "order_metrics_json": _sql(
            f"""SELECT '{{"{metrics.VISITS}":' || CAST({_VISITS_SQL} AS VARCHAR)
            || ',"{metrics.DURATION}":' || CAST({_DURATION_SQL} AS VARCHAR) || '}}' AS metrics""",
            gap=METRICS_GAP,
        ),
    }
    for kind in ORDER:
        suffix = "" if kind == "plain" else f"_{kind}"
        for end in (suffix, suffix + "_split"):
            for name, tail in _STEP_SQL.items():
                sql[name + end] = _sql(tail, kind)
            for name, tail in _FIGURE_SQL.items():
                sql[name + end] = _sql(tail, kind, METRICS_GAP)
    return sql | _llm("oracle_sql")

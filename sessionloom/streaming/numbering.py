"""Sessions of a stream of events, numbered as they come in.

Each customer's state is the time of the last event and the number of its session. Customers are dealt into
buckets, whose state is read and written as one: asking for it customer by customer takes longer than the numbering.
A batch's events are put in order of time, customer by customer, and go on from there, so the numbers are those ``sessionize`` gives to all events at
once, as long as no event is older than one of an earlier batch. Those that are come out marked ``late``
and without numbers: a late event may join two sessions and so change every later number, which only a look
at the customer's whole history can do (``operators.late.merge_late``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Generator, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sessionloom.columns import DEFAULT_GAP_MINUTES, Columns
from sessionloom.functions.expressions import MICROS_PER_MINUTE, micros_of
from sessionloom.session import require_utc

# The setting for the store that keyed state needs, and the store.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_ADDED = T.StructType(
    [
        T.StructField("time_diff", T.DoubleType()),
        T.StructField("new_session", T.IntegerType()),
        T.StructField("session_number", T.LongType()),
        T.StructField("late", T.BooleanType()),
    ]
)
# Fixed value: the number of buckets; a stream keeps the one it began with.
BUCKETS = 4096


def _state(customer: T.DataType) -> T.StructType:
    """A bucket's customers, the times of their last events, and the numbers of their sessions."""
    parts = {"customers": customer, "micros": T.LongType(), "sessions": T.LongType()}
    return T.StructType([T.StructField(name, T.ArrayType(of, False)) for name, of in parts.items()])


class _Numbers(StatefulProcessor):
    """Numbers one bucket's events of a batch. ``ties`` names the columns that order equal times."""

    def __init__(self, gap_minutes: float, customer: T.StructField, ties: Sequence[str]):
        self.gap, self.customer, self.ties = gap_minutes, customer.name, tuple(ties)
        self.schema = _state(customer.dataType)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # What is held here is one bucket's part of one batch; the trigger bounds it.
        events = defaultdict(list)
        for row in rows:
            events[self._key(row[self.customer])].append(row)
        state = self.last.get()
        held = {self._key(c): (c, m, s) for c, m, s in zip(*state)} if state else {}
        changed = False
        for customer, own in events.items():
            _, last, session = held.get(customer, (None, None, 0))
            after = yield from self._numbered(own, last, session)
            if after[0] is not None and after != (last, session):
                held[customer] = (own[0][self.customer], *after)
                changed = True
        if changed:
            self.last.update(tuple(list(part) for part in zip(*held.values())))

    def _key(self, customer):
        return bytes(customer) if isinstance(customer, bytearray) else customer

    def _numbered(self, rows: list[Row], last: int | None, session: int) -> Generator[Row, None, tuple]:
        """One customer's events with their numbers; gives the time of the last one and its session."""
        rows.sort(key=self._order)
        for row in rows:
            now = row["_micros"]
            if now is None:  # no time: in the first session, as in a batch
                yield self._out(row, 0.0, 0, 0, False)
            elif last is not None and now < last:
                yield self._out(row, None, None, None, True)
            else:
                minutes = (now - last) / MICROS_PER_MINUTE if last is not None else 0.0
                opens = int(minutes > self.gap)
                session += opens
                last = now
                yield self._out(row, minutes, opens, session, False)
        return last, session

    def _order(self, row: Row):
        values = (row["_micros"], *(row[c] for c in self.ties))
        return [(v is not None, v if v is not None else 0) for v in values]

    def _out(self, row: Row, *added) -> Row:
        return Row(*row.__fields__, *_ADDED.names)(*row, *added)

    def close(self) -> None:
        pass


def stream_session_numbers(
    events: DataFrame,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    cols: Columns = Columns(),
    *,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The stream's events with ``time_diff``, ``new_session``, session number and ``late``.

    Columns as in ``sessionize``. Events without a customer are dropped; those without a time are in session
    0. Events at the very time of the last one are in order. The state is one entry per customer and is kept
    with the stream's checkpoint, so a query that starts again goes on counting; a checkpoint from before customers
    were dealt into buckets does not fit. The session must use the RocksDB state store; ``use_rocks_db`` sets it.
    """
    require_utc(events, cols.timestamp)
    needed = dict.fromkeys([*keep, cols.customer, cols.timestamp, *cols.ties, cols.type])
    known = events.select(*needed).filter(F.col(cols.customer).isNotNull())
    timed = known.withColumn("_micros", micros_of(F.col(cols.timestamp)))
    timed = timed.withColumn("_bucket", F.pmod(F.xxhash64(cols.customer), F.lit(BUCKETS)).cast("int"))
    schema = T.StructType([*timed.schema.fields, *_ADDED.fields])
    out = timed.groupBy("_bucket").transformWithState(
        _Numbers(float(gap_minutes), timed.schema[cols.customer], cols.ties), schema, "Append", "None"
    )
    return out.select(
        *keep,
        cols.customer,
        cols.timestamp,
        "time_diff",
        "new_session",
        F.col("session_number").alias(cols.session),
        cols.type,
        "late",
    )


def use_rocks_db(spark: SparkSession) -> None:
    """Keep the state of streams started from now on in RocksDB, which keyed state needs."""
    spark.conf.set(STATE_STORE, ROCKS_DB)

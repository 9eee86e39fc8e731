"""The order metrics kept up to date: a new load changes them without a look at the events before it.

What is kept, in a folder:

* ``closed``: how often each value occurs that no later event can change, as counts per load. A customer's
  sessions between two orders are settled by the next order; the length of a session before the first
  order by the next session or that order.
* ``customers``: per customer the time of the last event, the number of its session, the orders so far, the
  session reached at the order before, and, before the first order, when the session began. A load adds
  rows for its own customers only; the newest row of a customer counts.

A load is read once. Its events are numbered together with one row per customer that stands for the last event
before it, and what that closes is added to the counts. The medians are those of the counts and of the
open values, which follow from the customers' rows. All files of a load become visible in one step.

A load whose events come before those already counted for a customer needs that customer's history: what was
closed is taken back and worked out again, for these customers only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.columns import DEFAULT_GAP_MINUTES, ORDER_TYPE, Columns
from sessionloom.functions.expressions import micros_of, micros_to_minutes, order_flag
from sessionloom.operators.history import SplitRule, stored
from sessionloom.operators.median import middle_values, midpoint
from sessionloom.operators.orders import OrderHistory
from sessionloom.plans.metrics import DURATION, VISITS
from sessionloom.session import require_utc
from sessionloom.sources.manifest import Manifest

COUNTS = "figure string, value long, n long"
CUSTOMERS = """customer {kind}, last long, session long, orders long, reached long, began long,
    untimed long, untimed_orders long, load long"""


@dataclass(frozen=True)
class StandingMetrics:
    """The two order metrics of the loads added to ``path`` so far."""

    spark: SparkSession
    path: str
    gap_minutes: float = DEFAULT_GAP_MINUTES
    order_type: str = ORDER_TYPE
    cols: Columns = Columns()
    rule: SplitRule = SplitRule()

    # --- reading --------------------------------------------------------------------------------

    def loads(self) -> dict[str, str]:
        """The loads that have been added, by name, and the folder of each."""
        return self._manifest().read()[1].get("loads", {})

    def closed(self) -> DataFrame:
        """How often each settled value occurs."""
        rows = self._read("closed", COUNTS)
        return rows.groupBy("figure", "value").agg(F.sum("n").alias("n")).filter("n != 0")

    def customers(self, kind: str = "long") -> DataFrame:
        """The newest row of every customer."""
        schema = CUSTOMERS.format(kind=kind)
        newest = self._read("customers", schema).groupBy("customer").agg(
            F.max_by(F.struct("*"), "load").alias("row")
        )
        return newest.select("row.*")

    def metrics(self) -> DataFrame:
        """Both metrics in one row, as ``order_metrics`` gives them for all events of all loads."""
        values = self.closed().unionByName(open_values(self.customers(self._kind())))
        return middle_values(values, "value", ["figure"], times="n").agg(
            midpoint(lambda v: v.cast("double"), F.col("figure") == "session_diff").alias(VISITS),
            midpoint(micros_to_minutes, F.col("figure") == "duration_micros").alias(DURATION),
        )

    # --- adding ---------------------------------------------------------------------------------

    def add(self, events: DataFrame, load: str, history: DataFrame | None = None) -> None:
        """Count one more load. A load of a name that has been added changes nothing.

        ``history`` has the events of the loads before. It is needed, and read, only for customers some of
        whose events here are not later than their last one; without it such a load is refused. Events
        without a customer are left out.
        """
        require_utc(events, self.cols.timestamp)
        if load in self.loads():
            return
        customer = self.cols.customer
        kind = events.schema[customer].dataType.simpleString()
        known = self._needed(events).filter(F.col(customer).isNotNull())
        before = self.customers(kind)
        first = known.groupBy(F.col(customer).alias("_c")).agg(F.min(micros_of(self._time())).alias("_first"))
        mine = before.join(first, F.col("customer") == F.col("_c"))
        mine = stored(mine, "standing-customers")
        late = mine.filter(F.col("_first") <= F.col("last")).select("_c")
        folder, no = f"load-{uuid.uuid4().hex}", len(self.loads())
        if late.isEmpty():
            closed, after = self._step(known, mine.drop("_c", "_first"))
        elif history is None:
            raise ValueError(f"{late.count()} customers of {load} have earlier events: pass the history")
        else:
            closed, after = self._again(known, mine, late, history)
        rows = closed.groupBy("figure", "value").agg(F.sum("n").alias("n")).filter("n != 0")
        rows.write.parquet(f"{self.path}/closed/{folder}")
        after = after.withColumn("load", F.lit(no).cast("long"))
        after.write.parquet(f"{self.path}/customers/{folder}")

        def step(held: dict) -> dict:
            if len(held.get("loads", {})) != no:
                raise RuntimeError("another load was added at the same time: add this one again")
            return {"kind": kind, "loads": held.get("loads", {}) | {load: folder}}

        self._manifest().change(step)

    def compact(self) -> None:
        """Put the files of all loads together: one row per value and one per customer."""
        folder, held = f"load-{uuid.uuid4().hex}", self._manifest().read()[1]
        if not held:
            return
        self.closed().write.parquet(f"{self.path}/closed/{folder}")
        self.customers(held["kind"]).write.parquet(f"{self.path}/customers/{folder}")

        def step(now: dict) -> dict:
            if now != held:
                raise RuntimeError("a load was added meanwhile: compact again")
            return {"kind": held["kind"], "loads": dict.fromkeys(held["loads"], folder)}

        self._manifest().change(step)

    # --- the work -------------------------------------------------------------------------------

    def _again(self, known: DataFrame, mine: DataFrame, late: DataFrame, history: DataFrame):
        """``_step`` for a load with late customers, whose settled values are worked out anew."""
        customer = self.cols.customer
        is_late = F.col(customer) == F.col("_c")
        old = self._needed(history).join(late, is_late, "left_semi")
        new = old.unionByName(known.join(late, is_late, "left_semi"))
        none = mine.drop("_c", "_first").limit(0)
        closed_old, _ = self._step(old, none)
        closed_new, after_late = self._step(new, none)
        rest = mine.join(late.withColumnRenamed("_c", "_l"), F.col("_c") == F.col("_l"), "left_anti")
        closed, after = self._step(known.join(late, is_late, "left_anti"), rest.drop("_c", "_first"))
        taken = closed_old.withColumn("n", -F.col("n"))
        return closed.unionByName(taken).unionByName(closed_new), after.unionByName(after_late)

    def _step(self, events: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The values that the events close, and their customers' new rows."""
        cols, customer = self.cols, self.cols.customer
        # The last event before the load, as a row of no type.
        carried = before.filter(F.col("last").isNotNull()).select(
            *[
                F.col("customer").alias(customer)
                if f.name == customer
                else F.timestamp_micros("last").cast(f.dataType).alias(f.name)
                if f.name == cols.timestamp
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in events.schema
            ]
        )
        untimed = F.col(cols.timestamp).isNull()
        plain = events.filter(untimed).groupBy(customer).agg(
            F.count(F.lit(1)).alias("more"),
            F.sum(order_flag(F.col(cols.type), self.order_type)).alias("more_orders"),
        )
        history = OrderHistory.of_events(
            events.filter(~untimed).unionByName(carried), self.gap_minutes, self.order_type, cols, rule=self.rule
        )
        old = before.withColumnsRenamed({c: f"_{c}" for c in before.columns})
        groups = history.lagged().join(old, F.col(customer) == F.col("_customer"), "left")
        past = F.coalesce(F.col("_session"), F.lit(0))
        number = F.col("order_number")
        groups = groups.select(
            customer,
            number.cast("long").alias("number"),
            (past + F.col("max_session_for_order")).alias("at"),
            # The first group goes on from the one before the load.
            F.when(number == 0, F.coalesce(F.col("_reached"), F.lit(0)))
            .otherwise(past + F.col("lagged_max_session_order"))
            .alias("reached"),
            F.coalesce(F.col("_orders"), F.lit(0)).alias("past_orders"),
        )
        last_group = groups.groupBy(customer).agg(
            F.max(F.struct("number", "at", "reached", "past_orders")).alias("last_group")
        )
        ends = groups.join(last_group, customer)
        closed = ends.filter(F.col("number") < F.col("last_group.number")).select(
            F.lit("session_diff").alias("figure"), (F.col("at") - F.col("reached")).alias("value")
        )
        # Sessions before the first order, of customers who had none before.
        spans = history.before_first_order().groupBy(customer, cols.session).agg(
            F.min(micros_of(self._time())).alias("began"), F.max(micros_of(self._time())).alias("ended")
        )
        spans = spans.join(old, F.col(customer) == F.col("_customer"), "left")
        spans = spans.filter(F.coalesce(F.col("_orders"), F.lit(0)) == 0)
        goes_on = (F.col(cols.session) == 0) & F.col("_began").isNotNull()
        spans = spans.select(
            customer,
            F.col(cols.session).alias("span"),
            F.when(goes_on, F.col("_began")).otherwise(F.col("began")).alias("began"),
            "ended",
        )
        last_span = spans.groupBy(customer).agg(F.max(F.struct("span", "began")).alias("last_span"))
        spans = spans.join(last_span, customer).join(last_group, customer)
        settled = (F.col("span") < F.col("last_span.span")) | (F.col("last_group.number") > 0)
        lengths = spans.filter(settled).select(
            F.lit("duration_micros").alias("figure"), (F.col("ended") - F.col("began")).alias("value")
        )
        closed = closed.unionByName(lengths).groupBy("figure", "value").agg(F.count(F.lit(1)).alias("n"))
        times = history.events().groupBy(customer).agg(F.max(micros_of(self._time())).alias("last"))
        timed = times.join(last_group, customer).join(last_span, customer, "left")
        orders = F.col("last_group.past_orders") + F.col("last_group.number")
        timed = timed.select(
            F.col(customer).alias("customer"),
            "last",
            F.col("last_group.at").alias("session"),
            orders.alias("orders"),
            F.col("last_group.reached").alias("reached"),
            F.when(orders == 0, F.col("last_span.began")).alias("began"),
        )
        plain = plain.withColumnRenamed(customer, "_p")
        both = timed.join(plain, F.col("customer") == F.col("_p"), "full_outer")
        both = both.withColumn("_key", F.coalesce("customer", "_p")).drop("customer", "_p")
        both = both.join(old, F.col("_key") == F.col("_customer"), "left")

        def newest(name: str):
            return F.when(F.col("last").isNotNull(), F.col(name)).otherwise(F.col(f"_{name}"))

        def total(name: str, added: str):
            return F.coalesce(F.col(f"_{name}"), F.lit(0)) + F.coalesce(F.col(added), F.lit(0))

        kept = ("session", "orders", "reached")
        after = both.select(
            F.col("_key").alias("customer"),
            F.coalesce("last", "_last").alias("last"),
            *[F.coalesce(newest(c), F.lit(0)).cast("long").alias(c) for c in kept],
            newest("began").alias("began"),
            total("untimed", "more").alias("untimed"),
            total("untimed_orders", "more_orders").alias("untimed_orders"),
        )
        return closed, after

    def _needed(self, events: DataFrame) -> DataFrame:
        cols = self.cols
        return events.select(*dict.fromkeys([cols.customer, cols.timestamp, *cols.ties, cols.type]))

    def _time(self):
        return F.col(self.cols.timestamp)

    def _manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self.path}/_loads")

    def _kind(self) -> str:
        return self._manifest().read()[1].get("kind", "long")

    def _read(self, part: str, schema: str) -> DataFrame:
        folders = sorted({f"{self.path}/{part}/{f}" for f in self.loads().values()})
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)


def open_values(customers: DataFrame) -> DataFrame:
    """The values that later events may still change, one row each: those of the customers' last groups and
    of the sessions of customers who have not ordered.

    Events without a time are in session 0 and count all orders. They form a group of their own behind the
    timed events if an order is among them.
    """
    timed, apart = F.col("last").isNotNull(), F.col("untimed_orders") > 0
    diffs = F.array(
        F.when(timed, F.col("session") - F.col("reached")),
        F.when((F.col("untimed") > 0) & (apart | ~timed), F.when(timed, -F.col("session")).otherwise(0)),
    )
    diffs = customers.select(F.lit("session_diff").alias("figure"), F.explode(diffs).alias("value"))
    lengths = customers.filter(timed & (F.col("orders") == 0)).select(
        F.lit("duration_micros").alias("figure"), (F.col("last") - F.col("began")).alias("value")
    )
    rows = diffs.filter(F.col("value").isNotNull()).unionByName(lengths)
    return rows.groupBy("figure", "value").agg(F.count(F.lit(1)).alias("n"))

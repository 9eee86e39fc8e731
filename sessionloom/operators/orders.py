"""Order numbering and the session figures around orders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.columns import DEFAULT_GAP_MINUTES, ORDER_TYPE, Columns
from sessionloom.functions.expressions import micros_to_minutes, order_flag, span_micros
from sessionloom.operators.history import (
    HotCustomers,
    SplitRule,
    free_prefix,
    hot_customers,
    numbered,
)
from sessionloom.session import require_utc


def with_order_flag(
    df: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns()
) -> DataFrame:
    """Add ``placed_order``: 1 for an order event, else 0."""
    return df.withColumn("placed_order", order_flag(F.col(cols.type), order_type))


class OrderHistory:
    """Events numbered by order, and the figures that follow from the numbers.

    Without long histories the events stay partitioned by customer, and all later steps run without
    another shuffle. With them they are partitioned by slices, and what leaves a slice is aggregated
    first.
    """

    def __init__(
        self,
        events: DataFrame,
        order_type: str = ORDER_TYPE,
        cols: Columns = Columns(),
        *,
        keep: Sequence[str] | None = None,
        hot: HotCustomers | None = None,
        rule: SplitRule = SplitRule(),
    ):
        """For sessionized events. ``keep`` names the columns to carry besides customer, time and
        session; default all."""
        require_utc(events, cols.timestamp)
        self.cols, self._session_is_added = cols, False
        self.hot = hot or hot_customers(events, cols.customer, rule, cols.timestamp)
        flagged = with_order_flag(events, order_type, cols).drop("order_number")
        if keep is not None:
            flagged = flagged.select(
                cols.customer, cols.timestamp, cols.session, *keep, "placed_order"
            )
        self._numbered = lambda wanted: numbered(
            flagged, cols, self.hot, flag="placed_order", wanted=wanted
        )

    @property
    def rows(self) -> DataFrame:
        """The events with all their columns."""
        return self._numbered(None)

    @property
    def lean(self) -> DataFrame:
        """The events for aggregates, which read customer, time, session and order number only."""
        return self._numbered(() if self._session_is_added else (self.cols.session,))

    @classmethod
    def of_events(
        cls,
        events: DataFrame,
        gap_minutes: float = DEFAULT_GAP_MINUTES,
        order_type: str = ORDER_TYPE,
        cols: Columns = Columns(),
        *,
        keep: Sequence[str] = (),
        hot: HotCustomers | None = None,
        rule: SplitRule = SplitRule(),
    ) -> OrderHistory:
        """For raw events: sessions and orders are numbered in one shuffle, from one list of hot
        customers. The rows are those of ``sessionize``, with the order columns."""
        if gap_minutes < 0:
            raise ValueError("a session length must not be negative")
        require_utc(events, cols.timestamp)
        needed = dict.fromkeys([*keep, cols.customer, cols.timestamp, *cols.ties, cols.type])
        known = events.select(*needed).filter(F.col(cols.customer).isNotNull())
        self = cls.__new__(cls)
        self.cols, self._session_is_added = cols, True
        self.hot = hot or hot_customers(known, cols.customer, rule, cols.timestamp)
        flagged = with_order_flag(known, order_type, cols)
        self._numbered = lambda wanted: numbered(
            flagged, cols, self.hot, [gap_minutes], "placed_order", wanted
        ).select(
            *keep,
            cols.customer,
            cols.timestamp,
            "time_diff",
            F.col("new_session_0").alias("new_session"),
            F.col("session_number_0").alias(cols.session),
            cols.type,
            "placed_order",
            "order_number",
        )
        return self

    @property
    def whole(self) -> bool:
        """Whether no history is split."""
        return self.hot.cuts is None

    def events(self) -> DataFrame:
        """Every event with ``placed_order`` and ``order_number``."""
        return self.rows

    def before_first_order(self) -> DataFrame:
        """Events of customers who have not ordered yet at that time."""
        return _unordered(self.rows)

    def groups(self) -> DataFrame:
        """One row per customer and order number: the last session reached."""
        return _last_sessions(self.lean, self.cols)

    def lagged(self) -> DataFrame:
        """``groups`` with the previous group's last session, 0 for a customer's first group."""
        if self.whole:
            return _lagged(self.groups(), self.cols)
        return _looked_up(_visits(self.lean, self.cols), self.cols)

    def diffs(self) -> DataFrame:
        """``lagged`` with ``session_diff``, the sessions between one order and the next."""
        return self.lagged().withColumn("session_diff", _session_diff())

    def durations(self) -> DataFrame:
        """One row per customer and session before the first order: its length."""
        return _durations(_unordered(self.lean), self.cols)

    def figures(self) -> DataFrame:
        """The values of ``diffs`` and ``durations`` in one frame.

        ``figure`` is 'session_diff' or 'duration_micros' and ``value`` the number. Both come from one
        pass over the events, or over their visits if histories are split.
        """
        if self.whole:
            return _figures(self.lean, self.cols)
        visits = _visits(self.lean, self.cols)
        diffs = _looked_up(visits, self.cols).select(
            F.lit("session_diff").alias("figure"), _session_diff().alias("value")
        )
        micros = span_micros(F.col("_first"), F.col("_last"))
        durations = _unordered(visits).select(
            F.lit("duration_micros").alias("figure"), micros.alias("value")
        )
        return diffs.unionByName(durations)

    def with_last_session(self) -> DataFrame:
        """Every event with ``max_session_for_order``, the last session of its order group."""
        return self._with_group_values(
            self.rows,
            [self.cols.customer, "order_number"],
            {"max_session_for_order": F.max(self.cols.session)},
        )

    def with_session_bounds(self) -> DataFrame:
        """Events before the first order with the first and last such event of their session."""
        ts = self.cols.timestamp
        return self._with_group_values(
            _unordered(self.rows),
            [self.cols.customer, self.cols.session],
            {"min_session_event": F.min(ts), "max_session_event": F.max(ts)},
        )

    def _with_group_values(self, df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
        if self.whole:  # a group is part of one history, so it is small enough for a window
            w = Window.partitionBy(*keys)
            return df.withColumns({name: value.over(w) for name, value in values.items()})
        # Groups of any size: aggregated in part before they are shuffled, then joined back. Spark
        # broadcasts the groups if they are small, and splits a group's rows if it is not.
        of = {k: f"{free_prefix(df)}{i}" for i, k in enumerate(keys)}
        groups = df.groupBy(*[F.col(k).alias(n) for k, n in of.items()]).agg(
            *[value.alias(name) for name, value in values.items()]
        )
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in of.items()])
        kept = [F.col(f"`{c}`") for c in df.columns if c not in values]
        return df.drop(*values).join(groups, same).select(*kept, *values)


def with_order_number(
    events: DataFrame,
    order_type: str = ORDER_TYPE,
    cols: Columns = Columns(),
    *,
    hot: HotCustomers | None = None,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """Add ``placed_order`` and ``order_number``, the customer's orders up to and at that time.

    Events at the very time of an order count it already. Events without a time come last.
    """
    return OrderHistory(events, order_type, cols, hot=hot, rule=rule).events()


def before_first_order(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """Events before the customer's first order; all events of customers who never order."""
    return OrderHistory(events, order_type, cols, **options).before_first_order()


def order_groups(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """Per customer and order number, the last session reached (``max_session_for_order``)."""
    return OrderHistory(events, order_type, cols, **options).groups()


def session_diffs(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """Sessions between successive orders, counting from 0 for a customer's first group.

    The events before any order and those after the last order form groups of their own.
    """
    return OrderHistory(events, order_type, cols, **options).diffs()


def session_durations(
    events: DataFrame, order_type: str = ORDER_TYPE, cols: Columns = Columns(), **options
) -> DataFrame:
    """Minutes per session before the first order; the session of the order is cut short there."""
    return OrderHistory(events, order_type, cols, **options).durations()


def _unordered(df: DataFrame) -> DataFrame:
    return df.filter(F.col("order_number") == 0)


def _last_sessions(df: DataFrame, cols: Columns) -> DataFrame:
    return df.groupBy(cols.customer, "order_number").agg(
        F.max(cols.session).alias("max_session_for_order")
    )


def _session_diff() -> Column:
    return F.col("max_session_for_order") - F.col("lagged_max_session_order")


def _figures(df: DataFrame, cols: Columns) -> DataFrame:
    """``figures`` of events that are partitioned by customer; no further shuffle is needed."""
    ts, order, session = cols.timestamp, F.col("order_number"), F.col(cols.session)
    visits = df.groupBy(cols.customer, "order_number", cols.session).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    w = Window.partitionBy(cols.customer).orderBy("order_number", cols.session)
    following = F.lead("order_number").over(w)
    visits = visits.withColumn("_ends_group", following.isNull() | (following != order))
    # Of a later group only the last session is kept, so a group end always follows the end of the
    # group before it. Group 0 is the first one.
    visits = visits.filter(F.col("_ends_group") | (order == 0))
    lagged = F.when(order == 0, 0).otherwise(F.coalesce(F.lag(session).over(w), F.lit(0)))
    visits = visits.withColumn("_lagged", lagged)
    diff = F.when(F.col("_ends_group"), session - F.col("_lagged"))
    micros = F.when(order == 0, span_micros(F.col("_first"), F.col("_last")))
    figures = F.array(
        F.struct(F.lit("session_diff").alias("figure"), diff.alias("value")),
        F.struct(F.lit("duration_micros").alias("figure"), micros.alias("value")),
    )
    return visits.select(F.inline(figures)).filter(F.col("value").isNotNull())


def _lagged(groups: DataFrame, cols: Columns) -> DataFrame:
    w = Window.partitionBy(cols.customer).orderBy("order_number")
    return groups.withColumn(
        "lagged_max_session_order",
        F.coalesce(F.lag("max_session_for_order").over(w), F.lit(0)),
    )


def _visits(df: DataFrame, cols: Columns) -> DataFrame:
    """One row per customer, order number and session: its time span and its orders."""
    ts = cols.timestamp
    return df.groupBy(cols.customer, "order_number", cols.session).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum("placed_order").alias("_orders")
    )


def _looked_up(visits: DataFrame, cols: Columns) -> DataFrame:
    """``_lagged`` without a window over the customer, who may have any number of orders.

    All orders of a group happen at the time that opens it, so the group before has the number from
    before those orders. Each group is sent to its own number and to that one, and the two meet
    there; the work spreads over customer and number.
    """
    groups = visits.groupBy(cols.customer, "order_number").agg(
        F.max(cols.session).alias("_reached"), F.sum("_orders").alias("_orders")
    )
    number, reached = F.col("order_number"), F.col("_reached")
    # Group 0 has no order and nothing before it; no group has the number -1.
    before = F.when(F.col("_orders") == 0, F.lit(-1)).otherwise(number - F.col("_orders"))
    sent = F.array(
        _sent(number, last=reached),
        _sent(before, number=number, own=reached),
    )
    met = groups.select(cols.customer, F.inline(sent)).groupBy(cols.customer, "_at")
    lagged = met.agg(*[F.max(c).alias(c) for c in ("_last", "_number", "_own")])
    kind = visits.schema[cols.session].dataType
    return lagged.filter(F.col("_number").isNotNull()).select(
        cols.customer,
        F.col("_number").alias("order_number"),
        F.col("_own").cast(kind).alias("max_session_for_order"),
        F.coalesce(F.col("_last"), F.lit(0)).cast(kind).alias("lagged_max_session_order"),
    )


def _sent(at: Column, **values: Column) -> Column:
    names = ("last", "number", "own")
    numbers = [values.get(n, F.lit(None)).cast("long").alias(f"_{n}") for n in names]
    return F.struct(at.cast("long").alias("_at"), *numbers)


def _durations(df: DataFrame, cols: Columns) -> DataFrame:
    bounds = df.groupBy(cols.customer, cols.session).agg(
        F.min(cols.timestamp).alias("_first"), F.max(cols.timestamp).alias("_last")
    )
    micros = span_micros(F.col("_first"), F.col("_last"))
    return bounds.select(
        cols.customer,
        cols.session,
        micros.alias("duration_micros"),
        micros_to_minutes(micros).alias("session_duration"),
    )

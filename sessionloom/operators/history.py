"""Splitting the histories of very active customers.

Most operators here walk through one customer's events in time order. A window over the customer
does that with one shuffle, but it puts a whole history into one task, and a single bot can own a
third of all rows. So long histories are cut:

1. ``hot_customers`` names the customers with more than ``hot_rows`` rows and takes quantiles of their
   times as cuts, one per ``slice_rows`` rows. An instant that several quantiles fall on is crowded:
   it gets a slice of its own, divided further into parts.
2. ``numbered`` gives every row its slice and shuffles the rows once, by (customer, slice, part); the
   windows for sessions and for orders both run inside. Ordinary customers have one slice.
3. One small row per (customer, slice) is carried along the slices by a window over those rows and
   joined back to finish the rows. That reads the same shuffle a second time, not the input.

No row is lost to a cap (``MOST_CUTS`` bounds one customer's slices by time): however many customers are hot and however many slices they have, none is left
whole. The list and the carried rows are broadcast only if they are counted to be small.

The list only decides which way a customer's rows take. Both ways give the same result, which is
why it may be estimated from a sample.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.columns import Columns
from sessionloom.functions.expressions import micros_of, minutes_between
from sessionloom.session import work_folder

SAMPLE_HITS = 2_000
SEED = 11
# Cuts that may be broadcast: eight bytes each. More of them are joined by shuffling.
BROADCAST_CUTS = 1_000_000
# Quantiles taken of one history. A history of more slices than that has larger slices.
MOST_CUTS = 10_000
CUTS_PER_STEP = 32


@dataclass(frozen=True)
class SplitRule:
    """``hot_rows``: a longer history is split. ``slice_rows``: rows aimed at per slice.

    A customer has at most ``MOST_CUTS`` slices by time; beyond ``MOST_CUTS * slice_rows`` rows (ten billion by
    default) its slices, and so the tasks, hold one row in ``MOST_CUTS`` of its history.
    """

    hot_rows: int = 5_000_000
    slice_rows: int = 1_000_000


@dataclass(frozen=True)
class HotCustomers:
    """``cuts``: customer, cuts, crowded, missing per hot customer; None if there are none.

    ``cuts`` are times in microseconds, ``crowded`` the instants among them that need several parts,
    with their number, and ``missing`` the number of parts for events without a time.
    """

    cuts: DataFrame | None
    small: bool = True
    crowded: bool = False
    searched: int = 0  # rows the search has looked at


def hot_customers(
    df: DataFrame,
    customer: str,
    rule: SplitRule = SplitRule(),
    timestamp: str = Columns().timestamp,
) -> HotCustomers:
    """Find the customers that own more than ``rule.hot_rows`` rows, and where to cut them.

    Reads one column, and a second time two columns of those customers if there are any. The sample
    is dense enough that a customer at the limit is hit about ``SAMPLE_HITS`` times; with a low limit
    it is the whole column.
    """
    share = min(1.0, SAMPLE_HITS / max(rule.hot_rows, 1))
    known = df.select(F.col(customer).alias("customer"), micros_of(F.col(timestamp)).alias("at"))
    if share < 1.0:
        known = known.sample(fraction=share, seed=SEED)
    counts = known.groupBy("customer").agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > rule.hot_rows * share
    # The longest one tells how fine the quantiles have to be, and whether there are any at all.
    first = counts.agg(
        F.sum("n").alias("searched"),
        F.max("n").alias("most"),
        F.count(F.when(many, 1)).alias("customers"),
        F.sum(F.when(many, F.col("n"))).alias("rows"),
    ).first()
    searched = first.searched or 0
    if not first.customers:
        return HotCustomers(None, searched=searched)
    found = counts.filter(many)
    fine = min(MOST_CUTS, max(2, math.ceil(first.most / share / rule.slice_rows)))
    ids = found.select(F.col("customer").alias("hot"))
    few = first.customers <= BROADCAST_CUTS
    ids = F.broadcast(ids) if few else ids
    rows = known.join(ids, F.col("customer").eqNullSafe(F.col("hot")), "left_semi")
    quantiles = F.percentile_approx("at", [i / fine for i in range(fine)], max(10_000, 4 * fine))
    own = F.greatest(F.ceil(F.col("n") / F.lit(share * rule.slice_rows)), F.lit(2))
    per = rows.groupBy("customer").agg(
        F.count(F.lit(1)).alias("n"), F.count("at").alias("timed"), quantiles.alias("every")
    )
    step = F.greatest(F.floor(F.lit(fine) / own), F.lit(1))
    per = per.withColumn(
        "some",
        F.coalesce(
            F.filter("every", lambda _, i: i % step == 0), F.array().cast("array<bigint>")
        ),
    )
    distinct = F.sort_array(F.array_distinct("some"))
    parts = F.transform(
        distinct,
        lambda c: F.struct(c.alias("at"), F.size(F.filter("some", lambda x: x == c)).alias("parts")),
    )
    cuts = per.select(
        "customer",
        distinct.alias("cuts"),
        F.filter(parts, lambda p: p["parts"] > 1).alias("crowded"),
        F.greatest(
            F.ceil((F.col("n") - F.col("timed")) / F.lit(share * rule.slice_rows)), F.lit(1)
        ).cast("int").alias("missing"),
    )
    expected = first.customers + first.rows / share / rule.slice_rows
    if few and 2 * expected <= BROADCAST_CUTS:
        listed = cuts.collect()
        crowded = any(r.crowded or r.missing > 1 for r in listed)
        listed = df.sparkSession.createDataFrame(listed, cuts.schema)
        return HotCustomers(listed, True, crowded, searched)
    return HotCustomers(stored(cuts, "cuts"), False, True, searched)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Store ``df`` in the shared folder and read it back."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def content_hash(df: DataFrame) -> Column:
    """A hash of all columns Spark can hash; maps and variants it cannot."""
    hashed = [
        f"`{f.name}`"
        for f in df.schema
        if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))
    ]
    return F.xxhash64(*hashed)


def free_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` starts with."""
    prefix = "_h_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def _opens(minutes: Column, gap: float) -> Column:
    return F.when(minutes > F.lit(float(gap)), 1).otherwise(0)


def _minutes_since(prev: Column, now: Column) -> Column:
    return F.coalesce(minutes_between(prev, now), F.lit(0.0))


def numbered(
    df: DataFrame,
    cols: Columns,
    hot: HotCustomers,
    gaps: Sequence[float] = (),
    flag: str | None = None,
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """Number the events of each customer, by sessions, by orders, or both in the same shuffle.

    With ``gaps`` the columns ``prev_timestamp``, ``time_diff`` and, for the i-th gap, ``new_session_<i>``
    and ``session_number_<i>`` are added; with ``flag``, a column of 0 and 1, ``order_number``, its sum
    up to and at that time. Sessions take events without a time first, orders take them last.

    ``wanted`` names the columns that will be read besides customer, time, ties and flag; default all.
    The slices' carried values then come from the same shuffle as the rows; with other columns they are
    as right, but the input is read once more.
    """
    if hot.cuts is None:
        return _numbered_whole(df, cols, gaps, flag)
    p = free_prefix(df)
    rows = _with_slices(df, cols, hot, p)
    rows = _inside_slices(rows, cols, gaps, flag, p)
    carry = _carried(rows, df.columns if wanted is None else wanted, cols, gaps, flag, p)
    return _finished(rows, F.broadcast(carry) if hot.small else carry, df.columns, cols, gaps, flag, p)


def _time_order(cols: Columns) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (cols.timestamp, *cols.ties)]


def _numbered_whole(df: DataFrame, cols: Columns, gaps: Sequence[float], flag: str | None) -> DataFrame:
    """One window over each customer."""
    out, ts = df, F.col(cols.timestamp)
    if gaps:
        w = Window.partitionBy(cols.customer).orderBy(*_time_order(cols))
        out = out.withColumn("prev_timestamp", F.lag(ts).over(w))
        out = out.withColumn("time_diff", _minutes_since(F.col("prev_timestamp"), ts))
        out = out.withColumns(
            {f"new_session_{i}": _opens(F.col("time_diff"), gap) for i, gap in enumerate(gaps)}
        )
        up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumns(
            {f"session_number_{i}": F.sum(f"new_session_{i}").over(up_to) for i in range(len(gaps))}
        )
    if flag:
        # No frame is given on purpose: the default one includes events at the same time.
        w = Window.partitionBy(cols.customer).orderBy(ts.asc_nulls_last())
        out = out.withColumn("order_number", F.sum(flag).over(w))
    return out


def _with_slices(df: DataFrame, cols: Columns, hot: HotCustomers, p: str) -> DataFrame:
    """Add the slice and part of each row; the slice is null for ordinary customers.

    Slices of a hot customer count up with time: -1 holds events without a time, 2i the i-th cut if it
    is crowded, and 2i + 1 what lies between the i-th cut and the next.
    """
    cuts = hot.cuts.select(*[F.col(c).alias(p + c) for c in ("customer", "cuts", "crowded", "missing")])
    cuts = F.broadcast(cuts) if hot.small else cuts
    rows = df.join(cuts, F.col(cols.customer).eqNullSafe(F.col(p + "customer")), "left")
    at = micros_of(F.col(cols.timestamp))
    # How many cuts are not after the time, counted in two steps: in every 32nd one, then nearby.
    steps = F.filter(p + "cuts", lambda _, i: i % CUTS_PER_STEP == 0)
    before = F.greatest(F.size(F.filter(steps, lambda c: c <= at)) - 1, F.lit(0)) * CUTS_PER_STEP
    near = F.slice(p + "cuts", before + 1, F.lit(CUTS_PER_STEP))
    number = before + F.size(F.filter(near, lambda c: c <= at))
    own = F.filter(p + "crowded", lambda c: c["at"] == at)
    parts = F.coalesce(F.try_element_at(own, F.lit(1))["parts"], F.lit(0))
    rows = rows.withColumn(
        p + "parts", F.when(at.isNull(), F.col(p + "missing")).otherwise(parts)
    ).withColumn(
        p + "slice",
        F.when(F.col(p + "customer").isNull(), F.lit(None))
        .when(at.isNull(), F.lit(-1))
        .otherwise(2 * number + F.when(parts > 0, 0).otherwise(1))
        .cast("long"),
    )
    rows = rows.select(*df.columns, p + "slice", p + "parts")
    one = rows.withColumn(p + "part", F.lit(0).cast("long"))
    if not hot.crowded:
        return one.drop(p + "parts")
    # Rows of a crowded slice are dealt out by their position. They are stored with it, so that a task
    # that is run again deals them out in the same way.
    several = F.col(p + "slice").isNotNull() & (F.col(p + "parts") > 1)
    place = F.pmod(F.monotonically_increasing_id(), F.col(p + "parts").cast("long"))
    dealt = stored(rows.filter(several).withColumn(p + "part", place), "crowded")
    return one.filter(~F.coalesce(several, F.lit(False))).unionByName(dealt).drop(p + "parts")


def _inside_slices(rows, cols: Columns, gaps: Sequence[float], flag: str | None, p: str) -> DataFrame:
    """What the rows of one slice and part tell about each other."""
    ts = F.col(cols.timestamp)
    inside = Window.partitionBy(cols.customer, p + "slice", p + "part")
    if gaps:
        w = inside.orderBy(*_time_order(cols))
        up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns(
            {p + "head": F.row_number().over(w) == 1, p + "prev": F.lag(ts).over(w)}
        )
        minutes = _minutes_since(F.col(p + "prev"), ts)
        rows = rows.withColumns({f"{p}new_{i}": _opens(minutes, gap) for i, gap in enumerate(gaps)})
        rows = rows.withColumns(
            {f"{p}run_{i}": F.sum(f"{p}new_{i}").over(up_to) for i in range(len(gaps))}
        )
    if flag:
        rows = rows.withColumn(p + "orders", F.sum(flag).over(inside.orderBy(ts.asc_nulls_last())))
    return rows


def _carried(rows, wanted: Sequence[str], cols: Columns, gaps: Sequence[float], flag: str | None, p: str):
    """One row per slice of a hot customer: what the slices before it add to its rows."""
    customer, ts, kinds = cols.customer, F.col(cols.timestamp), range(len(gaps))
    # Naming the wanted columns makes this read the very shuffle that the rows themselves come from.
    named = [F.col(f"`{c}`").isNull() for c in wanted]
    present = F.max(reduce(Column.__or__, named, F.lit(False)))
    per_part = rows.groupBy(customer, p + "slice", p + "part").agg(
        present.alias(p + "present"),
        F.max(p + "slice").alias(p + "hot"),
        F.min(ts).alias(p + "first"),
        F.max(ts).alias(p + "last"),
        (_first_tie(cols, p) if gaps else F.lit(0)).alias(p + "tie"),
        *[F.max(f"{p}run_{i}").alias(f"{p}inner_{i}") for i in kinds],
        *([F.sum(flag).alias(p + "flags")] if flag else []),
    )
    # Not before the aggregation: that filter would make another shuffle of it.
    per_part = per_part.filter(F.col(p + "present").isNotNull() & F.col(p + "hot").isNotNull())
    # Of the parts of a crowded slice, that with the smallest tie holds the slice's first event.
    per_slice = per_part.groupBy(customer, p + "slice").agg(
        F.min(p + "first").alias(p + "first"),
        F.max(p + "last").alias(p + "last"),
        F.min_by(p + "part", F.struct(p + "tie", p + "part")).alias(p + "head_part"),
        *[F.sum(f"{p}inner_{i}").alias(f"{p}inner_{i}") for i in kinds],
        *([F.sum(p + "flags").alias(p + "flags")] if flag else []),
    )
    along = Window.partitionBy(customer).orderBy(p + "slice")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.withColumn(p + "before_it", F.lag(p + "last").over(along))
    minutes = _minutes_since(F.col(p + "before_it"), F.col(p + "first"))
    carry = carry.withColumns({f"{p}opens_{i}": _opens(minutes, gap) for i, gap in enumerate(gaps)})
    for i in kinds:
        before = F.sum(F.col(f"{p}opens_{i}") + F.col(f"{p}inner_{i}")).over(earlier)
        carry = carry.withColumn(f"{p}base_{i}", F.coalesce(before, F.lit(0)) + F.col(f"{p}opens_{i}"))
    keep = [p + "before_it", p + "head_part"]
    keep += [f"{p}{name}_{i}" for i in kinds for name in ("opens", "base")]
    if flag:
        # Events without a time come last: their slice counts the orders of all the others.
        timed = F.when(F.col(p + "slice") >= 0, F.col(p + "flags"))
        total = F.sum(p + "flags").over(Window.partitionBy(customer))
        carry = carry.withColumn(
            p + "flags_before",
            F.when(F.col(p + "slice") < 0, total - F.col(p + "flags")).otherwise(
                F.coalesce(F.sum(timed).over(earlier), F.lit(0))
            ),
        )
        keep += [p + "flags", p + "flags_before"]
    return carry.select(
        F.col(customer).alias(p + "of"), F.col(p + "slice").alias(p + "slice_of"), *keep
    )


def _first_tie(cols: Columns, p: str) -> Column:
    return F.max(F.when(F.col(p + "head"), F.struct(*[F.col(f"`{c}`") for c in cols.ties])))


def _finished(rows, carry, given: list[str], cols: Columns, gaps, flag: str | None, p: str) -> DataFrame:
    same = F.col(cols.customer).eqNullSafe(F.col(p + "of")) & (
        F.col(p + "slice") == F.col(p + "slice_of")
    )
    rows = rows.join(carry, same, "left")
    ts, hot = F.col(cols.timestamp), F.col(p + "slice").isNotNull()
    added = {}
    if gaps:
        # The first row of a part follows the row before the slice, or an event of the same time.
        starts = hot & F.col(p + "head")
        first = starts & (F.col(p + "part") == F.col(p + "head_part"))
        prev = F.when(first, F.col(p + "before_it")).when(starts, ts).otherwise(F.col(p + "prev"))
        added |= {"prev_timestamp": prev, "time_diff": _minutes_since(prev, ts)}
        for i in range(len(gaps)):
            own = F.col(f"{p}new_{i}")
            added[f"new_session_{i}"] = F.when(first, F.col(f"{p}opens_{i}")).otherwise(own)
        for i in range(len(gaps)):
            base = F.coalesce(F.col(f"{p}base_{i}"), F.lit(0))
            added[f"session_number_{i}"] = base + F.col(f"{p}run_{i}")
    if flag:
        one_time = hot & ((F.col(p + "slice") < 0) | (F.col(p + "slice") % 2 == 0))
        here = F.when(one_time, F.col(p + "flags")).otherwise(F.col(p + "orders"))
        added["order_number"] = F.coalesce(F.col(p + "flags_before"), F.lit(0)) + here
    return rows.select(*[F.col(f"`{c}`") for c in given], *[v.alias(n) for n, v in added.items()])

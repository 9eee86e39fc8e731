"""How many sessions there are for any session length, from one look at the events.

A pause opens a session for every length it exceeds, so all that matters of a customer's events is which
pauses lie between them. The spectrum holds each customer's pauses with their numbers; it has as many rows as
there are different pauses, and answers for hundreds of lengths at once without another window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.columns import Columns
from sessionloom.functions.expressions import MICROS_PER_MINUTE, span_micros
from sessionloom.operators.history import HotCustomers, SplitRule
from sessionloom.operators.sessions import session_columns


def gap_spectrum(
    events: DataFrame,
    cols: Columns = Columns(),
    *,
    hot: HotCustomers | None = None,
    rule: SplitRule = SplitRule(),
) -> DataFrame:
    """customer, ``pause_micros`` and ``pauses``, how many of that length the customer has.

    A customer's first event follows no pause: one row per customer has a null pause and stands for its
    first session. Events without a customer are left out; those without a time are in the first session.
    """
    needed = dict.fromkeys([cols.customer, cols.timestamp, *cols.ties, cols.type])
    rows = session_columns(events.select(*needed), [0], cols, hot=hot, rule=rule)
    pause = span_micros(F.col("prev_timestamp"), F.col(cols.timestamp))
    # Pauses of no length open no session, whatever the length; the null row has the customer's first one.
    pause = F.when(pause > 0, pause)
    counts = rows.groupBy(cols.customer, pause.alias("pause_micros")).agg(F.count(F.lit(1)).alias("pauses"))
    first = F.col("pause_micros").isNull()
    return counts.withColumn("pauses", F.when(first, F.lit(1)).otherwise(F.col("pauses")).cast("long"))


def merged_spectra(spectra: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Spectra of disjoint sets of customers, or parts of one, put together."""
    pause = F.col("pause_micros")
    sums = spectra.groupBy(cols.customer, "pause_micros").agg(F.sum("pauses").alias("pauses"))
    return sums.withColumn("pauses", F.when(pause.isNull(), F.lit(1)).otherwise(F.col("pauses")).cast("long"))


def sessions_by_gap(spectrum: DataFrame, gaps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``gap_minutes`` and ``sessions`` for every length, over all customers or per group of columns ``by``.

    Each pause finds its place among the sorted lengths by halving, partial sums per place are shuffled, and
    the sums of the places above a length are its sessions. Lengths must not be negative; equal ones are
    given once. Without customers every length has no session, and there are no groups.
    """
    lengths = sorted({float(g) for g in gaps})
    if not lengths or lengths[0] < 0:
        raise ValueError("session lengths must be given and not be negative")
    minutes = F.col("pause_micros").cast("double") / F.lit(MICROS_PER_MINUTE)
    # A first session counts for every length.
    place = F.when(F.col("pause_micros").isNull(), F.lit(len(lengths))).otherwise(_place(minutes, lengths))
    sums = spectrum.groupBy(*by, place.alias("_place")).agg(F.sum("pauses").alias("_n"))
    # At most one entry per length and group.
    places = sums.groupBy(*by).agg(F.collect_list(F.struct("_place", "_n")).alias("_places"))
    listed = F.array(*[F.lit(g) for g in lengths])
    rows = places.select(*by, "_places", F.posexplode(listed).alias("_at", "gap_minutes"))
    above = F.filter("_places", lambda p: p["_place"] > F.col("_at"))
    total = F.aggregate(above, F.lit(0).cast("long"), lambda n, p: n + p["_n"])
    return rows.select(*by, "gap_minutes", total.alias("sessions"))


def _place(value: Column, bounds: list[float], low: int = 0, high: int | None = None) -> Column:
    """How many of the sorted bounds lie below the value, by halving."""
    high = len(bounds) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    above = _place(value, bounds, middle + 1, high)
    return F.when(value > F.lit(bounds[middle]), above).otherwise(_place(value, bounds, low, middle))

"""Late events put into sessions that are numbered already.

An event that comes late can begin a session, lengthen one, or join two, and every later number of its
customer may change, but no other customer's. So only the histories that late events touch are numbered
again; the rest is passed on as it is, without a shuffle as long as the list of touched customers is small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.columns import DEFAULT_GAP_MINUTES, Columns
from sessionloom.operators.history import BROADCAST_CUTS, SplitRule, stored
from sessionloom.operators.sessions import sessionize


@dataclass(frozen=True)
class LateMerge:
    """``untouched``: sessionized rows as they were. ``rewritten``: all rows of the touched customers, numbered
    anew. ``touched``: those customers, stored."""

    untouched: DataFrame
    rewritten: DataFrame
    touched: DataFrame

    def events(self) -> DataFrame:
        """All rows together, as ``sessionize`` gives them for all events."""
        return self.untouched.unionByName(self.rewritten)


def merge_late(
    sessions: DataFrame,
    late: DataFrame,
    gap_minutes: float = DEFAULT_GAP_MINUTES,
    cols: Columns = Columns(),
    *,
    keep: Sequence[str] = (),
    rule: SplitRule = SplitRule(),
) -> LateMerge:
    """Put late events into the rows of ``sessionize``; ``keep`` names the further columns of both.

    ``sessions`` must have been made with the same length. Late events without a customer are left out, those
    without a time are in session 0. Customers who are new are touched customers without earlier rows.
    """
    customer = cols.customer
    known = late.filter(F.col(customer).isNotNull())
    touched = stored(known.select(F.col(customer).alias("_touched")).distinct(), "late-customers")
    few = touched.count() <= BROADCAST_CUTS
    listed = F.broadcast(touched) if few else touched
    is_touched = F.col(customer) == F.col("_touched")
    needed = list(dict.fromkeys([*keep, customer, cols.timestamp, *cols.ties, cols.type]))
    earlier = sessions.join(listed, is_touched, "left_semi").select(*needed)
    columns = [c for c in [*keep, customer, cols.timestamp, "time_diff", "new_session", cols.session, cols.type]]
    return LateMerge(
        sessions.join(listed, is_touched, "left_anti").select(*columns),
        sessionize(earlier.unionByName(known.select(*needed)), gap_minutes, cols, keep=keep, rule=rule),
        touched,
    )

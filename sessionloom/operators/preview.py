"""A look at the first or last events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ROWS = 5


def view(
    df: DataFrame, order_by: Sequence[str], side: str = "top", nrow: int = DEFAULT_ROWS
) -> DataFrame:
    """The first (``top``) or last (``bottom``) ``nrow`` rows, in ascending order.

    ``order_by`` should tell all rows apart; every task then keeps ``nrow`` rows of its own.
    """
    if side not in ("top", "bottom"):
        raise ValueError("side is 'top' or 'bottom'")
    if nrow < 0:
        raise ValueError("nrow must not be negative")
    ascending = [F.col(c).asc_nulls_first() for c in order_by]
    if side == "top":
        return df.orderBy(*ascending).limit(nrow)
    last = df.orderBy(*[F.col(c).desc_nulls_last() for c in order_by]).limit(nrow)
    return last.orderBy(*ascending)

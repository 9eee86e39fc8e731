"""Medians from sketches that can be stored per load and merged.

A sketch (Spark's KLL aggregate) keeps a few hundred values, however many it has seen. The rank of what it
gives as a quantile is off by less than ``rank_error`` of all values, with 99 % confidence, also after
merging. ``exact_median`` and ``median_by`` give the exact value at the price of a shuffle of all values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sketch's size parameter, and the published fit of its rank error.
K = 400
ERROR_FACTOR, ERROR_POWER = 2.296, 0.9723


def rank_error(k: int = K) -> float:
    """The share of all values by which a rank may be off."""
    return ERROR_FACTOR / k**ERROR_POWER


def sketch_values(df: DataFrame, value: str, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One ``sketch`` per group of a whole-number column, and ``values``, how many it has seen.

    Nulls are ignored; a group without a value gives no row. Partial sketches are made before the shuffle.
    """
    rows = df.select(*by, F.col(value).cast("long").alias("_v")).filter(F.col("_v").isNotNull())
    sketch = F.kll_sketch_agg_bigint("_v", F.lit(k)).alias("sketch")
    out = rows.groupBy(*by).agg(sketch, F.count(F.lit(1)).alias("values"))
    return out.filter(F.col("values") > 0)


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """The sketches of several loads as one per group."""
    merged = F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch")
    out = sketches.groupBy(*by).agg(merged, F.sum("values").alias("values"))
    return out.filter(F.col("values") > 0)


def sketch_median(
    sketches: DataFrame,
    by: Sequence[str] = (),
    name: str = "median",
    scale: Callable[[Column], Column] = lambda v: v.cast("double"),
) -> DataFrame:
    """The approximate median of each sketch; no interpolation between two middle values."""
    middle = F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5))
    return sketches.select(*by, scale(middle).alias(name))


def rank_range(df: DataFrame, value: str, of: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The exact ranks, as shares of all values, between which the value ``name`` of ``of`` lies.

    ``of`` has one row per group. To check a sketch against the values it has seen.
    """
    names = {c: f"_of_{i}" for i, c in enumerate(by)}
    told = of.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(name).alias("_told"))
    same = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    rows = df.filter(F.col(value).isNotNull()).join(told, same)
    below = F.sum((F.col(value) < F.col("_told")).cast("long"))
    up_to = F.sum((F.col(value) <= F.col("_told")).cast("long"))
    n = F.count(F.lit(1))
    return rows.groupBy(*by).agg((below / n).alias("rank_from"), (up_to / n).alias("rank_to"), n.alias("values"))

"""Exact median of whole numbers without gathering the values in one task.

Spark's own ``median`` merges the counts of all distinct values into a single task. Here the two
middle values are narrowed down digit by digit instead: a long has 64 bits, read as one digit of 22
bits and two of 21. Each step counts the values per digit, which partial aggregation does before the
shuffle, and walks over at most 2**22 sums to see which digit holds the middle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.session import work_folder

# Bits left below each digit; the last step is the value itself.
SHIFTS = (42, 21, 0)


def exact_median(
    df: DataFrame,
    value: str,
    name: str = "median",
    scale: Callable[[Column], Column] = lambda v: v.cast("double"),
) -> DataFrame:
    """One row with the interpolated median of a whole-number column, as a double.

    Nulls are ignored and no values give null. ``scale`` is applied to the two middle values before
    they are averaged; it must not change their order.
    """
    return middle_values(df, value).agg(midpoint(scale).alias(name))


def midpoint(scale: Callable[[Column], Column], where: Column | None = None) -> Column:
    """Aggregate of ``middle_values``: the mean of the two, within the group ``where`` selects."""
    middle = F.col("middle") if where is None else F.when(where, F.col("middle"))
    lower, upper = (F.max(F.when(F.col(place), middle)) for place in ("lower", "upper"))
    return F.lit(0.5) * scale(lower) + F.lit(0.5) * scale(upper)


def middle_values(
    df: DataFrame, value: str, by: Sequence[str] = (), times: str | None = None
) -> DataFrame:
    """The ``middle`` value, or the two of them if the count is even, with their places.

    One row is both ``lower`` and ``upper``, or each of two rows is one of them. ``by`` names
    columns with a few distinct values; each combination that has any value gets its own rows.
    ``times`` names a column that says how often a row counts; what adds up to 0 is no value.
    """
    by = list(by)
    counts = _counted(df, value, by, times)
    found = _first_digit(counts, by)
    for above, shift in zip(SHIFTS, SHIFTS[1:]):
        found = _next_digit(counts, by, found, above, shift)
    return found.select(
        *by,
        F.col("_digit").alias("middle"),
        _holds("_low").alias("lower"),
        _holds("_high").alias("upper"),
    )


def _counted(df: DataFrame, value: str, by: list[str], times: str | None) -> DataFrame:
    """How often each value occurs in its group, as ``_v`` and ``_n``."""
    often = F.lit(1) if times is None else F.col(times)
    rows = df.select(*by, F.col(value).cast("long").alias("_v"), often.cast("long").alias("_n"))
    counts = rows.filter(F.col("_v").isNotNull()).groupBy(*by, "_v").agg(F.sum("_n").alias("_n"))
    return counts if times is None else counts.filter(F.col("_n") != 0)


def median_by(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    name: str = "median",
    scale: Callable[[Column], Column] = lambda v: v.cast("double"),
    times: str | None = None,
) -> DataFrame:
    """The exact, interpolated median of a whole-number column in every group, for any number of groups of
    any size.

    The counted values are sorted by group and value in ranges; a group of many values lies in several of
    them. Each range's total per group is carried to the ranges after it, which gives every value its
    ranks, and the rows that hold the middle ranks are the only ones that leave. No group, and no list
    of groups, has to fit a task. Groups without a value give no row; a null is a group like any other.
    """
    by = list(by)
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = _counted(df, value, by, times).repartitionByRange(ranges, *by, "_v")
    # Stored, so that the numbers of the ranges are fixed.
    path = work_folder(spark, "median-counts")
    counts.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    counts = spark.read.parquet(path)
    groups = [F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)]
    sums = counts.groupBy(*groups, F.col("_range").alias("_in")).agg(F.sum("_n").alias("_sum"))
    names = [f"_by_{i}" for i in range(len(by))]
    group = Window.partitionBy(*names)
    before = group.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns(
        {
            "_before": F.coalesce(F.sum("_sum").over(before), F.lit(0)),
            "_total": F.sum("_sum").over(group),
        }
    )
    # Only ranges that hold a middle rank go on.
    low, high = F.shiftright(F.col("_total") - 1, 1), F.shiftright("_total", 1)
    end = F.col("_before") + F.col("_sum")
    sums = sums.withColumns({"_low": low, "_high": high})
    sums = sums.filter((F.col("_low") < end) & (F.col("_high") >= F.col("_before"))).drop("_sum", "_total")
    same = F.col("_range") == F.col("_in")
    for c, n in zip(by, names):
        same = same & F.col(c).eqNullSafe(F.col(n))
    inside = counts.join(sums, same)
    along = Window.partitionBy(*names, "_in").orderBy("_v")
    up_to = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = inside.withColumn("_start", F.col("_before") + up_to - F.col("_n"))
    middle = inside.filter(_holds("_low") | _holds("_high")).select(
        *names, F.col("_v").alias("middle"), _holds("_low").alias("lower"), _holds("_high").alias("upper")
    )
    out = middle.groupBy(*names).agg(midpoint(scale).alias("_median"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(by, names)], F.col("_median").alias(name))


def _first_digit(counts: DataFrame, by: list[str]) -> DataFrame:
    digit = F.shiftright("_v", SHIFTS[0]).alias("_digit")
    sums = counts.groupBy(*by, digit).agg(F.sum("_n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*by))
    ranks = {"_low": F.shiftright(total - 1, 1), "_high": F.shiftright(total, 1)}
    return _middle_digits(sums.withColumns(ranks), by)


def _next_digit(
    counts: DataFrame, by: list[str], found: DataFrame, above: int, shift: int
) -> DataFrame:
    parents = found.select(
        *[F.col(c).alias(f"_of_{c}") for c in by],
        F.col("_digit").alias("_parent"),
        (F.col("_low") - F.col("_start")).alias("_low"),
        (F.col("_high") - F.col("_start")).alias("_high"),
    )
    same = F.shiftright("_v", above) == F.col("_parent")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    # At most two parents per group, so the broadcast has a few rows.
    inside = counts.join(F.broadcast(parents), same)
    sums = inside.groupBy(*by, "_parent", F.shiftright("_v", shift).alias("_digit")).agg(
        F.sum("_n").alias("_n"), F.max("_low").alias("_low"), F.max("_high").alias("_high")
    )
    return _middle_digits(sums, [*by, "_parent"])


def _middle_digits(sums: DataFrame, within: list[str]) -> DataFrame:
    """The one or two digits that hold the ranks ``_low`` and ``_high``, counted from 0."""
    along = Window.partitionBy(*within).orderBy("_digit")
    up_to = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = sums.withColumn("_start", up_to - F.col("_n"))
    return sums.filter(_holds("_low") | _holds("_high"))


def _holds(rank: str) -> Column:
    return F.col(rank).between(F.col("_start"), F.col("_start") + F.col("_n") - 1)

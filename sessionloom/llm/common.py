"""Helpers that several operators share: words, stored tables, ranks, hot-key-safe prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.session import work_folder

# The bytes that separate words.
WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD_BREAK_CHARS = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts the lineage, so a lost executor costs a re-read, and values that depend on how rows
    were dealt out (partition numbers, row positions) are fixed from then on.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(text: str) -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def text_key(text: str) -> Column:
    """64 bits of the text; with the id they tell rows apart that repeat an id."""
    return F.xxhash64(whole_text(text))


def word_array(text: Column) -> Column:
    """Maximal runs of bytes that separate no words; an empty array if there are none."""
    trimmed = F.btrim(text, F.lit(WORD_BREAK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WORD_BREAK)
    )


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WORD_BREAK_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_BREAK)))


def with_rank(df: DataFrame, order: list[str], within: list[str], name: str) -> DataFrame:
    """A gapless rank from 0 inside each ``within`` group, in the given order.

    Rows are range-partitioned, so a group that holds most of the table spreads over many tasks;
    one small row per (partition, group) carries the ranks across. Partition and position are fixed
    by storing the sorted rows. The input must not have columns that start with ``_rank_``.
    """
    keys = [*within, *order]
    dealt = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    # Position in the partition: the low 33 bits of the id that Spark gives each row.
    row = F.monotonically_increasing_id()
    dealt = stored(
        dealt.withColumns(
            {"_rank_part": F.spark_partition_id(), "_rank_row": row.bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        "ranked",
    )
    counts = dealt.groupBy("_rank_part", *within).agg(
        F.count(F.lit(1)).alias("_rank_n"), F.min("_rank_row").alias("_rank_first")
    )
    before = Window.partitionBy(*within).orderBy("_rank_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = counts.withColumn(
        "_rank_base", F.coalesce(F.sum("_rank_n").over(before), F.lit(0))
    ).drop("_rank_n")
    renamed = counts.withColumnsRenamed({c: f"_rank_{i}" for i, c in enumerate(within)})
    same = F.col("_rank_part") == F.col("_rank_p")
    for i, c in enumerate(within):
        same = same & F.col(c).eqNullSafe(F.col(f"_rank_{i}"))
    joined = dealt.join(renamed.withColumnRenamed("_rank_part", "_rank_p"), same)
    rank = F.col("_rank_base") + F.col("_rank_row") - F.col("_rank_first")
    return joined.withColumn(name, rank).select(*df.columns, name)


def permuted(df: DataFrame, x: str, n: str, key: str) -> DataFrame:
    """Put column ``x`` through a pseudorandom permutation of 0..n-1, chosen by ``key``.

    Plain integer arithmetic in three rounds; each multiplies by a prime modulo n and then treats the
    front and the back part of the range as two smaller ranges. Every step is one-to-one because the
    prime does not divide the length (the next one is taken where it does). Exact for n up to 2**46.
    """
    x_, n_, key_ = F.col(x), F.col(n), F.col(key)
    for r in range(3):
        df = df.withColumn(x, _affine(x_, n_, key_ * 7919 + (r * 104729 + 13)))
        cut = F.greatest(F.floor(n_ * (5 + 2 * r) / 13), F.lit(1)).cast("long")
        front = _affine(x_, cut, key_ * 6131 + (r * 15485863 + 7))
        rest = _affine(
            x_ - cut, F.greatest(n_ - cut, F.lit(1)), key_ * 3571 + (r * 32452843 + 3)
        )
        df = df.withColumn(x, F.when(x_ < cut, n_ - cut + front).otherwise(rest))
    return df


# Primes just below 2**29. Multiplied in two parts of 14 and 15 bits, so that the products with
# numbers below 2**46 fit a long.
PRIMES = (536870909, 536870879, 536870869, 536870849, 536870839, 536870837, 536870819, 536870813)


def _affine(x: Column, n: Column, key: Column) -> Column:
    """x * a + c modulo n, with a prime ``a`` picked by the key that does not divide n."""
    pick = F.pmod(key, F.lit(4))
    a = F.lit(PRIMES[0]).cast("long")
    for i in range(4):
        first, second = PRIMES[i], PRIMES[i + 4]
        usable = F.when(n % first != 0, F.lit(first)).otherwise(F.lit(second)).cast("long")
        a = F.when(pick == i, usable).otherwise(a)
    high = F.pmod(x * F.shiftright(a, 15), n) * F.lit(1 << 15).cast("long")
    return F.pmod(F.pmod(high + x * a.bitwiseAND(F.lit((1 << 15) - 1)), n) + F.pmod(key * 31 + 17, n), n)


def permuted_sql(x: str, n: str, key: str) -> list[str]:
    """The same permutation as steps of SQL text; see ``permuted``."""
    steps = []
    for r in range(3):
        steps.append(_affine_sql(x, n, f"({key} * 7919 + {r * 104729 + 13})"))
        cut = f"greatest({n} * {5 + 2 * r} // 13, 1)"
        front = _affine_sql(x, cut, f"({key} * 6131 + {r * 15485863 + 7})")
        rest = _affine_sql(
            f"({x} - {cut})", f"greatest({n} - {cut}, 1)", f"({key} * 3571 + {r * 32452843 + 3})"
        )
        steps.append(f"CASE WHEN {x} < {cut} THEN {n} - {cut} + {front} ELSE {rest} END")
    return steps


def _affine_sql(x: str, n: str, key: str) -> str:
    a = " ".join(
        f"WHEN {i} THEN CASE WHEN {n} % {PRIMES[i]} <> 0 THEN {PRIMES[i]} ELSE {PRIMES[i + 4]} END"
        for i in range(4)
    )
    return f"(({x} * (CASE {key} % 4 {a} END) + (({key} * 31 + 17) % {n})) % {n})"

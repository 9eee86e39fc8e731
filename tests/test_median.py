import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from sessionloom import exact_median
from sessionloom.operators.median import middle_values


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v long")


@pytest.mark.parametrize(
    "values,expected",
    [
        ([1, 2], 1.5),
        ([1, 2, 4, None], 2.0),
        ([5], 5.0),
        ([], None),
        ([None], None),
        ([-3, -1], -2.0),
        ([-(2**62), -1, 0, 2**62], -0.5),
        ([7] * 9 + [1, 2, 9], 7.0),
        ([0, 2**42, 2**42 + 1, 2**43], 2**42 + 0.5),
        ([2**21 - 1, 2**21], 2**21 - 0.5),
    ],
)
def test_small(spark, values, expected):
    assert exact_median(frame(spark, values), "v").first()[0] == expected


def test_equals_the_builtin(spark):
    rng = random.Random(5)
    for scale in (10, 2**20, 2**40, 2**60):
        for size in (999, 1000):
            values = [rng.randrange(-scale, scale) for _ in range(size)]
            df = frame(spark, values)
            ours = exact_median(df, "v").first()[0]
            assert ours == df.agg(F.median("v")).first()[0] == pytest.approx(median(values))


def test_groups(spark):
    rows = [("a", 1), ("a", 2), ("a", 9), ("b", -5), ("b", 7), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    found = middle_values(df, "v", ["k"])
    got = {tuple(r) for r in found.select("k", "middle", "lower", "upper").collect()}
    assert got == {("a", 2, True, True), ("b", -5, True, False), ("b", 7, False, True)}


def test_scale(spark):
    df = frame(spark, [1, 2])
    assert exact_median(df, "v", "m", lambda v: v / F.lit(2)).first().m == 0.75


def test_the_values_are_counted_once(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("v")).repartition(4)
    out = exact_median(df, "v")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Range (") == 1 and plan.count("ReusedExchange") == 2

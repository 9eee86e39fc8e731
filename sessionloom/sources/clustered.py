"""Files in ranges of the sort order, with a map of what each of them holds.

The first rows of a table that is kept this way are in its first file or two, so they are found without a
look at the others, and without a sort of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.operators.preview import view

ZONES = "_zones"


def write_clustered(df: DataFrame, uri: str, order_by: Sequence[str], files: int | None = None) -> None:
    """Write the rows in ``files`` ranges of ``order_by``, ascending with nulls first, replacing what is there.

    Default as many ranges as shuffle partitions. Rows with equal values are in one file: name enough columns
    to tell rows apart. The map has one row per file: its number of rows, its least and its greatest key.
    """
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by).write.mode("overwrite").parquet(uri)
    key = F.struct(*order_by)
    held = spark.read.schema(df.schema).parquet(uri).withColumn("file", F.col("_metadata.file_name"))
    zones = held.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("greatest")
    )
    zones.write.mode("overwrite").parquet(f"{uri.rstrip('/')}/{ZONES}")


def read_zones(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.parquet(f"{uri.rstrip('/')}/{ZONES}")


def view_clustered(spark: SparkSession, uri: str, side: str = "top", rows: int = 5) -> DataFrame:
    """The first or last rows in the files' order, as ``view`` gives them, read from the files that may
    hold them only.

    The files with the least greatest keys that have ``rows`` rows together bound what is asked for; a file
    that begins beyond that bound cannot hold any of it. The driver looks at no more files than rows.
    """
    if side not in ("top", "bottom") or rows < 0:
        raise ValueError("the side is top or bottom, and the number of rows not negative")
    zones = read_zones(spark, uri)
    order_by = zones.schema["least"].dataType.names
    near, far = ("greatest", "least") if side == "top" else ("least", "greatest")

    def sorted_by(column: str) -> Column:
        return F.col(column).asc_nulls_first() if side == "top" else F.col(column).desc_nulls_last()

    bound, held = None, 0
    for zone in zones.orderBy(sorted_by(near)).limit(max(rows, 1)).select("rows", near).collect():
        bound, held = zone[near], held + zone["rows"]
        if held >= rows:
            break
    schema = spark.read.parquet(uri).schema
    if bound is None:
        return view(spark.createDataFrame([], schema), order_by, side, rows)
    kind = T.StructType([T.StructField("_bound", zones.schema[near].dataType)])
    limit = F.broadcast(spark.createDataFrame([(bound,)], kind))  # one row
    reached = F.col(far) <= F.col("_bound") if side == "top" else F.col(far) >= F.col("_bound")
    files = [f"{uri.rstrip('/')}/{r.file}" for r in zones.join(limit, reached).select("file").collect()]
    return view(spark.read.schema(schema).parquet(*files), order_by, side, rows)

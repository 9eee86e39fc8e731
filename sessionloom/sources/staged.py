"""Staged files: sessionized events as Parquet, with hyphenated names in a fixed order."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.columns import STAGED_SCHEMA, TABLE_SCHEMA
from sessionloom.operators.preview import view
from sessionloom.session import hadoop_path

SAMPLE_ROWS = 10
POLL_SECONDS = 5


def as_staged(sessionized: DataFrame) -> DataFrame:
    """The staged columns, in order and under their staged names and types."""
    return sessionized.select(
        *[
            F.col(f.name.replace("-", "_")).cast(f.dataType).alias(f.name)
            for f in STAGED_SCHEMA.fields
        ]
    )


GENERATION = "_generation"


def write_staged(sessionized: DataFrame, uri: str) -> None:
    """Write to a folder on any file system Spark can reach, replacing what is there.

    No shuffle is added. A small file beside the rows names this generation of them, so that a stream
    that follows the folder can tell a rerun from more files.
    """
    as_staged(sessionized).write.mode("overwrite").parquet(uri)
    files, path = hadoop_path(sessionized.sparkSession, f"{uri.rstrip('/')}/{GENERATION}")
    out = files.create(path, True)
    out.write(bytearray(uuid.uuid4().hex.encode()))
    out.close()


def generation(spark: SparkSession, uri: str) -> str:
    """The name of the folder's generation; '0' if something else has written it."""
    files, path = hadoop_path(spark, f"{uri.rstrip('/')}/{GENERATION}")
    if not files.exists(path):
        return "0"
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def is_staged(spark: SparkSession, uri: str) -> bool:
    """Whether a finished write has left the folder."""
    files, path = hadoop_path(spark, f"{uri.rstrip('/')}/_SUCCESS")
    return files.exists(path)


def wait_until_staged(
    spark: SparkSession, uri: str, seconds: float, poll: float = POLL_SECONDS
) -> None:
    """Look for staged files every ``poll`` seconds; give up after ``seconds``."""
    end = time.monotonic() + seconds
    while not is_staged(spark, uri):
        if time.monotonic() >= end:
            raise TimeoutError(f"nothing was staged in {uri} within {seconds} seconds")
        time.sleep(min(poll, max(0.0, end - time.monotonic())))


def by_position(files: DataFrame) -> DataFrame:
    """Rows of staged files under the table's names, column by column, whatever theirs are called.

    Another number of columns or another type is an error. Narrower numbers are widened.
    """
    given, wanted = files.schema.fields, STAGED_SCHEMA.fields
    if len(given) != len(wanted):
        raise ValueError(f"staged files have {len(wanted)} columns; these have {len(given)}")
    for at, (have, want) in enumerate(zip(given, wanted), 1):
        if not _fits(have.dataType, want.dataType):
            raise TypeError(
                f"column {at} ({have.name}) is {have.dataType.simpleString()}, "
                f"not {want.dataType.simpleString()}"
            )
    renamed = files.toDF(*TABLE_SCHEMA.fieldNames())
    return renamed.select(
        *[F.col(n).cast(f.dataType).alias(n) for n, f in zip(TABLE_SCHEMA.fieldNames(), wanted)]
    )


def _fits(have: T.DataType, want: T.DataType) -> bool:
    if isinstance(want, T.IntegralType):
        return isinstance(have, T.IntegralType)
    if isinstance(want, T.DoubleType):
        return isinstance(have, (T.DoubleType, T.FloatType))
    return have == want


def read_staged(spark: SparkSession, uri: str) -> DataFrame:
    """Staged rows under the table's column names, matched by position.

    The files' own schemas are merged, so a folder whose files disagree on names is refused as well.
    """
    return by_position(spark.read.option("mergeSchema", "true").parquet(uri))


def sample_staged(
    spark: SparkSession, uri: str, rows: int = SAMPLE_ROWS, order_by: Sequence[str] = ()
) -> DataFrame:
    """The first ``rows`` rows, to see whether the stage can be read; any rows if unordered."""
    staged = read_staged(spark, uri)
    return view(staged, order_by, nrow=rows) if order_by else staged.limit(rows)

"""Staged files as a stream: each file is loaded once, as soon as it is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionloom.columns import DATABASE, STAGED_SCHEMA, TABLE, TABLE_SCHEMA, Columns
from sessionloom.sources.staged import POLL_SECONDS, by_position, generation, is_staged
from sessionloom.sources.warehouse import (
    as_table_rows,
    ensure_tables,
    publish,
    stage_id,
)


def read_staged_stream(
    spark: SparkSession, uri: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Staged files as they arrive, under the table's column names, matched by position.

    The folder need not be there yet: the pattern is looked up anew for every batch. The columns' names
    are taken from the files that are there; without any, they must be the staged ones.
    """
    schema = STAGED_SCHEMA
    if is_staged(spark, uri):
        schema = spark.read.option("mergeSchema", "true").parquet(uri).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return by_position(reader.parquet(f"{uri.rstrip('/')}/*.parquet"))


def stream_load(
    spark: SparkSession,
    uri: str,
    checkpoint: str,
    database: str = DATABASE,
    table: str = TABLE,
    *,
    location: str | None = None,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Add staged files to the table, looking for new ones every ``POLL_SECONDS``.

    Every batch is a load of its own, so one that is tried again replaces itself, and rows of other
    folders and of batch loads stay. When the ETL has replaced the folder, its new rows replace those of
    the generation before. A stream that starts from nothing replaces what the table holds of that
    folder. With ``available_now`` the query loads what is there and ends.
    """
    name, stage = ensure_tables(spark, database, table, location), stage_id(uri)

    def load(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        if not batch.filter(F.col(TABLE_SCHEMA[0].name).isNull()).isEmpty():
            raise ValueError(f"files in {uri} have other column names than the ones first seen")
        kept = f"stream-{stage}-{generation(session, uri)}-"

        def stays(other: str) -> bool:
            return stage not in other or (other.startswith(kept) and epoch > 0)

        publish(as_table_rows(batch), name, f"{kept}{epoch}", keep=stays)

    writer = read_staged_stream(spark, uri, max_files_per_trigger).writeStream
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(load)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{POLL_SECONDS} seconds")
    return writer.start()


def stream_sessions(
    events: DataFrame,
    gap_minutes: int,
    late: str,
    cols: Columns = Columns(),
) -> DataFrame:
    """Sessions of a stream of events, each given once when no more of it can arrive.

    A pause of exactly ``gap_minutes`` does not end a session, as in ``sessionize``. Events without
    a timestamp belong to no window and are left out; sessions are numbered in batch, since a late
    one would change the numbers after it.
    """
    opened = events.withColumn(cols.timestamp, F.col(cols.timestamp).cast("timestamp"))
    opened = opened.filter(F.col(cols.customer).isNotNull()).withWatermark(cols.timestamp, late)
    return (
        opened.groupBy(
            cols.customer, F.session_window(cols.timestamp, f"{gap_minutes} minutes").alias("_w")
        )
        .agg(
            F.min(cols.timestamp).alias("session_start"),
            F.max(cols.timestamp).alias("session_last"),
            F.count(F.lit(1)).alias("events"),
        )
        .drop("_w")
    )

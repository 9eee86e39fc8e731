"""The warehouse table the metrics are computed from.

Each load fills a partition of its own. Which partitions are the table's rows is said by a manifest beside
them (``_loads`` in the table's folder), which a load replaces in one step when its rows are written: a reader
sees the rows from before a load or those from after it, whatever happens in between.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.columns import DATABASE, TABLE, TABLE_SCHEMA
from sessionloom.functions.expressions import whole_minutes
from sessionloom.sources.manifest import Manifest
from sessionloom.sources.staged import read_staged


LOAD = "load_id"
MANIFEST = "_loads"


def quoted(*names: str) -> str:
    """A name for SQL text, each part in backticks."""
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def ensure_tables(
    spark: SparkSession, database: str = DATABASE, table: str = TABLE, location: str | None = None
) -> str:
    """Create database and table unless they exist; gives the table's full name for SQL text.

    Each load fills a partition of its own (``load_id``), so batch and stream share one table, and a
    load that is repeated replaces its own rows.
    """
    place = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{place}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in TABLE_SCHEMA.fields)
    name = quoted(database, table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {LOAD} STRING) USING parquet "
        f"PARTITIONED BY ({LOAD})"
    )
    if LOAD not in spark.table(name).columns:
        raise ValueError(f"{name} is no table of this version: it has no column {LOAD}")
    return name


def stage_id(uri: str) -> str:
    """A short name for a staged folder."""
    return hashlib.md5(uri.rstrip("/").encode()).hexdigest()[:12]


def table_folder(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


def manifest(spark: SparkSession, name: str) -> Manifest:
    """The table's manifest: which partition holds each visible load."""
    return Manifest(spark, f"{table_folder(spark, name)}/{MANIFEST}")


def write_partition(rows: DataFrame, name: str, part: str) -> None:
    """Write the rows as a new partition. It is written in its own folder, not through the table's, where
    loads that are written at the same time would share the folder for unfinished files."""
    spark = rows.sparkSession
    columns = [F.col(f.name) for f in TABLE_SCHEMA.fields]
    rows.select(*columns).write.parquet(f"{table_folder(spark, name)}/{LOAD}={part}")
    spark.sql(f"ALTER TABLE {name} ADD PARTITION ({LOAD} = '{part}')")


def visible_loads(spark: SparkSession, name: str) -> dict[str, str]:
    """The loads a reader sees, and their partitions. A table without a manifest shows all partitions."""
    version, held = manifest(spark, name).read()
    return held if version else {load: load for load in loads(spark, name)}


def publish(
    rows: DataFrame, name: str, load: str, keep: Callable[[str], bool] = lambda other: True
) -> None:
    """Write the rows as a load and make it visible in one step, in place of what it held before.

    Other loads for which ``keep`` is false vanish in the same step. Partitions that the version before
    this one shows stay on disk, so that readers who have begun can finish; what only older versions show is
    removed. What a load has left that failed half way is never shown; ``remove_unseen`` removes it.
    """
    spark, part = rows.sparkSession, f"{load}-{uuid.uuid4().hex[:12]}"
    table = manifest(spark, name)
    if not table.versions() and (old := loads(spark, name)):  # a table from before there were manifests
        table.change(lambda held: held or {p: p for p in old})
    write_partition(rows, name, part)
    version, before, after = table.change(
        lambda held: {k: p for k, p in held.items() if k != load and keep(k)} | {load: part}
    )
    past = table.read(version - 2)[1] if version - 2 in table.versions() else {}
    drop_loads(spark, name, sorted({*past.values()} - {*before.values(), *after.values()}))


def remove_unseen(spark: SparkSession, name: str) -> list[str]:
    """Remove the partitions that no reader sees. For quiet times: a load that is being written is not seen
    yet, and a reader who began before the last load may still read what was seen then."""
    shown = set(visible_loads(spark, name).values())
    gone = [part for part in loads(spark, name) if part not in shown]
    drop_loads(spark, name, gone)
    return gone


def loads(spark: SparkSession, name: str) -> list[str]:
    """All partitions of the table, those included that no reader sees."""
    return [r[0].removeprefix(f"{LOAD}=") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def replace_load(rows: DataFrame, name: str, load: str) -> None:
    """Write the rows as that load, in place of what it held before."""
    spark, view = rows.sparkSession, f"load_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    columns = ", ".join(quoted(f.name) for f in TABLE_SCHEMA.fields)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD} = '{load}') SELECT {columns} FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def drop_loads(spark: SparkSession, name: str, gone: list[str]) -> None:
    for load in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({LOAD} = '{load}')")


def as_table_rows(staged: DataFrame) -> DataFrame:
    """Staged rows cast to the table's types. A number that does not fit fails the job."""
    columns = {f.name: F.col(f.name).cast(f.dataType) for f in TABLE_SCHEMA.fields}
    columns["time_diff"] = whole_minutes(F.col("time_diff"))
    return staged.select(*[column.alias(name) for name, column in columns.items()])


def rejected_rows(staged: DataFrame) -> DataFrame:
    """Staged rows with a number that does not fit the table's types."""
    lost: list[Column] = [
        F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in TABLE_SCHEMA.fields
    ]
    return staged.filter(reduce(Column.__or__, lost))


def load_events(
    spark: SparkSession,
    uri: str,
    database: str = DATABASE,
    table: str = TABLE,
    *,
    location: str | None = None,
    skip_rejected: bool = False,
) -> DataFrame:
    """Fill the table from staged files, column by column in order, and give the table.

    The load replaces the table's rows, those of a stream too, so running it again changes nothing. With ``skip_rejected``
    rows that do not fit are left out instead of failing the job; ``rejected_rows`` lists them.
    """
    name = ensure_tables(spark, database, table, location)
    staged = read_staged(spark, uri)
    if skip_rejected:
        fits = [
            F.col(f.name).isNull() | F.col(f.name).try_cast(f.dataType).isNotNull()
            for f in TABLE_SCHEMA.fields
        ]
        staged = staged.filter(reduce(Column.__and__, fits))
    publish(as_table_rows(staged), name, f"batch-{stage_id(uri)}", keep=lambda other: False)
    return scan_events(spark, database, table)


def scan_events(spark: SparkSession, database: str = DATABASE, table: str = TABLE) -> DataFrame:
    """All rows of the table, as of the last load that has finished."""
    name = quoted(database, table)
    spark.catalog.refreshTable(name)
    shown = sorted(visible_loads(spark, name).values())
    rows = spark.table(name).filter(F.col(LOAD).isin(shown))
    return rows.select(*[F.col(f.name) for f in TABLE_SCHEMA.fields])

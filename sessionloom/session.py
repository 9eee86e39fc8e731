"""Spark settings the library counts on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import TimestampNTZType

# Names of the zone without offset.
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "Zulu", "+00:00", "UCT", "Universal")


def build_session(master: str | None = None, app: str = "sessionloom", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Timestamps are naive, so the session time zone is UTC: any other zone would bend values that
    fall into its daylight-saving gaps. Keyword names use ``__`` in place of dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Streamed events of one session are merged before the shuffle.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def require_utc(df: DataFrame, timestamp: str) -> None:
    """Refuse naive timestamps in a session whose zone would bend them."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if isinstance(df.schema[timestamp].dataType, TimestampNTZType) and zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sessionloom-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session, whose tasks all run on this machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _local_folder()
    folder = f"{base.rstrip('/')}/sessionloom/{purpose}-{uuid.uuid4().hex}"
    _made.get().append(folder)
    return folder


_made: ContextVar[list[str]] = ContextVar("made", default=[])


def hadoop_path(spark: SparkSession, uri: str):
    """The file system of a folder or file, and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@contextmanager
def folders_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shared folders made inside the block, once it has written its result."""
    mine: list[str] = []
    before = _made.set(mine)
    try:
        yield
    finally:
        _made.reset(before)
        for folder in mine:
            files, path = hadoop_path(spark, folder)
            files.delete(path, True)

"""Column names and schemas shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Columns:
    """Names of the columns the operators read.

    ``tie`` orders events of one customer that carry the same timestamp, by type if none is named.
    It decides only which of them holds the ``new_session`` flag; session and order numbers never
    depend on it.
    """

    customer: str = "customer_id"
    timestamp: str = "timestamp"
    type: str = "type"
    session: str = "session_number"
    tie: tuple[str, ...] = ()

    @property
    def ties(self) -> tuple[str, ...]:
        return self.tie or (self.type,)


# Fixed values up to the end of the file: names, order and types of the raw, staged and loaded
# records, names of database, table and order type, and the default pause.
_RAW_FIELDS = [
    T.StructField("type", T.StringType()),
    T.StructField("customer-id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
]
# A field may stand at the top of a record or inside its struct.
RAW_SCHEMA = T.StructType([*_RAW_FIELDS, T.StructField("event", T.StructType(_RAW_FIELDS))])

STAGED_SCHEMA = T.StructType(
    [
        T.StructField("customer-id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("time-diff", T.DoubleType()),
        T.StructField("new-session", T.IntegerType()),
        T.StructField("session-number", T.LongType()),
        T.StructField("type", T.StringType()),
    ]
)

TABLE_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("time_diff", T.IntegerType()),
        T.StructField("new_session", T.IntegerType()),
        T.StructField("session_number", T.IntegerType()),
        T.StructField("type", T.StringType()),
    ]
)

DATABASE = "webshop"
TABLE = "events"
ORDER_TYPE = "placed_order"
DEFAULT_GAP_MINUTES = 30

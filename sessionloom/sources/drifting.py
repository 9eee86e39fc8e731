"""Raw records whose fields drift: other types, other places, new fields, lines that are no records.

``read_events_json`` reads with a schema and fails on what does not fit. Here every line is parsed as it is
(Spark's VARIANT), the profile counts which fields there are by place and kind, and the lines that cannot be
taken as events are set aside with the reason, so that one odd producer does not stop the load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.columns import Columns
from sessionloom.functions.expressions import parse_timestamp

# How the types of a JSON value are told, and the fields of an event.
KINDS = {"STRING": "text", "BOOLEAN": "flag", "VOID": "null", "ARRAY": "list", "OBJECT": "struct"}
CUSTOMER, TIMESTAMP, TYPE = "customer-id", "timestamp", "type"

NO_RECORD = "no JSON object"
BAD_CUSTOMER = "the customer is no whole number"
BAD_TIME = "the timestamp is no time"
BAD_TYPE = "the type is no text"


@dataclass(frozen=True)
class Sifted:
    """``events``: the records that can be taken as events. ``aside``: the other lines, each with a reason."""

    events: DataFrame
    aside: DataFrame

    def quarantine(self, uri: str) -> None:
        """Add the lines that were set aside to a folder, one subfolder per reason."""
        self.aside.write.mode("append").partitionBy("reason").parquet(uri)


def read_lines(spark: SparkSession, uri: str | list[str]) -> DataFrame:
    """The lines of text files as ``line``; blank ones are left out."""
    lines = spark.read.text(uri).withColumnRenamed("value", "line")
    return lines.filter(F.trim("line") != "")


def kind_of(value: Column) -> Column:
    """text, number, flag, null, list or struct; null if there is no value."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return F.when(value.isNotNull(), F.coalesce(F.element_at(kinds, name), F.lit("number")))


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with further columns, each worked out once per row.

    Spark moves a filter below the columns it asks for and puts their expressions in their place, so that every
    use is worked out anew; rows of a generator it takes as they are.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _records(lines: DataFrame) -> DataFrame:
    parsed = _once(lines, {"record": F.try_parse_json("line")})
    return parsed.withColumn("_whole", F.coalesce(kind_of(F.col("record")) == "struct", F.lit(False)))


def field_profile(lines: DataFrame, struct: str = "event") -> DataFrame:
    """``place`` (top or inside), ``field``, ``kind`` and ``records``: how many records have the field so.

    Lines that are no JSON object are counted with the kind ``no record`` and neither place nor field. A
    table without lines gives no rows.
    """
    tvf, records = lines.sparkSession.tvf, _records(lines)
    whole = records.filter("_whole").select("record")

    def fields(of: DataFrame, place: str, value: str) -> DataFrame:
        held = of.lateralJoin(tvf.variant_explode(F.col(value).outer()))
        return held.select(F.lit(place).alias("place"), F.col("key").alias("field"), F.col("value"))

    top = fields(whole, "top", "record")
    inner = whole.select(F.try_variant_get("record", _path(struct), "variant").alias("inner"))
    inside = fields(inner.filter(kind_of(F.col("inner")) == "struct"), "inside", "inner")
    found = top.unionByName(inside).select("place", "field", kind_of(F.col("value")).alias("kind"))
    none = F.lit(None).cast("string")
    lost = records.filter(~F.col("_whole")).select(
        none.alias("place"), none.alias("field"), F.lit("no record").alias("kind")
    )
    return found.unionByName(lost).groupBy("place", "field", "kind").agg(F.count(F.lit(1)).alias("records"))


def sift(
    lines: DataFrame,
    struct: str = "event",
    cols: Columns = Columns(),
    keep: dict[str, str] | None = None,
) -> Sifted:
    """Tell events from lines that are none.

    A field may stand at the top of a record or inside its struct; the top comes first unless it is null. The
    customer must be a whole number, the timestamp a text of the accepted form, the type a text; each may be
    missing or null. ``keep`` names further fields and their Spark types; what does not fit becomes null.
    """
    fields = (CUSTOMER, TIMESTAMP, TYPE, *(keep or {}))
    rows = _once(_records(lines), {n: c for i, f in enumerate(fields) for n, c in _places(i, struct, f).items()})
    rows = _once(rows, {f"_v{i}": _field(i) for i in range(len(fields))})
    customer, time, kind = (F.col(f"_v{i}") for i in range(3))
    values = {
        "_number": F.try_variant_get(customer, "$", "bigint"),
        "_double": F.try_variant_get(customer, "$", "double"),
        "_time": F.try_variant_get(time, "$", "string"),
    }
    rows = _once(rows, values)
    rows = _once(rows, {"_parsed": parse_timestamp(F.col("_time"))})
    number, parsed = F.col("_number"), F.col("_parsed")
    exact = F.col("_double") == number
    reason = (
        F.when(~F.col("_whole"), NO_RECORD)
        .when(customer.isNotNull() & ~F.coalesce((kind_of(customer) == "number") & exact, F.lit(False)), BAD_CUSTOMER)
        .when(time.isNotNull() & ((kind_of(time) != "text") | parsed.isNull()), BAD_TIME)
        .when(kind.isNotNull() & (kind_of(kind) != "text"), BAD_TYPE)
    )
    rows = _once(rows, {"reason": reason})
    more = [
        F.try_variant_get(F.col(f"_v{i}"), "$", of).alias(field.replace("-", "_"))
        for i, (field, of) in enumerate((keep or {}).items(), start=3)
    ]
    events = rows.filter(F.col("reason").isNull()).select(
        *more,
        number.alias(cols.customer),
        parsed.alias(cols.timestamp),
        F.try_variant_get(kind, "$", "string").alias(cols.type),
    )
    return Sifted(events, rows.filter(F.col("reason").isNotNull()).select("line", "reason"))


def _path(*names: str) -> str:
    return "$" + "".join(f"['{n}']" for n in names)


def _places(i: int, struct: str, name: str) -> dict[str, Column]:
    """What stands at the top and inside for the i-th field."""
    paths = {"top": (name,), "inside": (struct, name)}
    return {f"_{place}{i}": F.try_variant_get("record", _path(*path), "variant") for place, path in paths.items()}


def _field(i: int) -> Column:
    """The field's value at the top or else inside; null if it is missing or null in both places."""
    found = [F.col(f"_{place}{i}") for place in ("top", "inside")]
    return F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in found])

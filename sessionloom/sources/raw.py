"""Raw events: newline-delimited JSON with a nested struct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.columns import RAW_SCHEMA, Columns
from sessionloom.functions.expressions import parse_timestamp

BAD_LINE = "_corrupt_record"


def read_events_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = RAW_SCHEMA,
    *,
    keep_bad_lines: bool = False,
) -> DataFrame:
    """Read one JSON object per line.

    With ``schema=None`` Spark infers it from all records, which reads the data twice. A malformed
    line fails the job; with ``keep_bad_lines`` it becomes a row whose text is in ``BAD_LINE``.
    """
    reader = spark.read
    if keep_bad_lines:
        if schema is not None and BAD_LINE not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    else:
        reader = reader.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def empty_events(spark: SparkSession, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """A frame of that schema with no rows."""
    return spark.createDataFrame([], schema)


def flatten(df: DataFrame, struct: str = "event") -> DataFrame:
    """Put the fields of a struct column next to the other columns, in its place.

    Hyphens in column names become underscores, so that names can be used in SQL text.
    """
    inner = df.schema[struct].dataType
    if not isinstance(inner, T.StructType):
        raise TypeError(f"{struct} is not a struct")
    out = []
    for field in df.schema:
        if field.name == struct:
            out += [(F.col(f"`{struct}`").getField(name), name) for name in inner.fieldNames()]
        else:
            out.append((F.col(f"`{field.name}`"), field.name))
    names = [_plain_name(name) for _, name in out]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns would occur twice: {', '.join(twice)}")
    return df.select(*[column.alias(name) for (column, _), name in zip(out, names)])


def flatten_names(df: DataFrame) -> DataFrame:
    """Hyphens in column names as underscores."""
    return df.withColumnsRenamed({name: _plain_name(name) for name in df.columns})


def _plain_name(name: str) -> str:
    return name.replace("-", "_")


REQUIRED = ("customer", "timestamp", "type")


def merged(df: DataFrame, struct: str = "event") -> DataFrame:
    """As ``flatten``, but a name may occur at the top and in the struct: the top value comes first."""
    inner = df.schema[struct].dataType
    if not isinstance(inner, T.StructType):
        raise TypeError(f"{struct} is not a struct")
    found: dict[str, list] = {}
    for field in df.schema:
        if field.name == struct:
            for name in inner.fieldNames():
                found.setdefault(_plain_name(name), []).append(F.col(f"`{struct}`").getField(name))
        else:
            found.setdefault(_plain_name(field.name), []).append(F.col(f"`{field.name}`"))
    return df.select(*[F.coalesce(*values).alias(name) for name, values in found.items()])


def typed_events(
    raw: DataFrame,
    struct: str = "event",
    cols: Columns = Columns(),
    seen: Observation | None = None,
) -> DataFrame:
    """Flatten raw events, drop those without a customer, and parse their timestamps.

    Each field may stand at the top of a record or inside the struct. A field that the schema has in
    neither place is an error; ``seen`` counts the values of each, for ``check_values``.
    """
    flat = _with_required(raw, struct, cols)
    if seen is not None:
        flat = flat.observe(seen, *_value_counts(cols))
    flat = flat.filter(F.col(cols.customer).isNotNull())
    return flat.withColumn(cols.timestamp, parse_timestamp(F.col(cols.timestamp)))


def _with_required(raw: DataFrame, struct: str, cols: Columns) -> DataFrame:
    flat = merged(raw, struct)
    absent = [n for n in (getattr(cols, part) for part in REQUIRED) if n not in flat.columns]
    if absent:
        raise ValueError(f"the records have no field {', '.join(absent)}")
    return flat


def _value_counts(cols: Columns) -> list[Column]:
    counts = [F.count(F.col(getattr(cols, part))).alias(part) for part in REQUIRED]
    return [F.count(F.lit(1)).alias("records"), *counts]


def counted_values(raw: DataFrame, struct: str = "event", cols: Columns = Columns()) -> dict[str, int]:
    """The number of records, and of values of each required field."""
    return _with_required(raw, struct, cols).agg(*_value_counts(cols)).first().asDict()


def check_values(counts: dict[str, int]) -> None:
    """Refuse records of which none has a value for one of the fields: they would be lost silently."""
    empty = [part for part in REQUIRED if counts["records"] and not counts[part]]
    if empty:
        raise ValueError(f"none of {counts['records']} records has a value for: {', '.join(empty)}")

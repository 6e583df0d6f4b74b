"""Change feeds and registries from files or a message stream, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entity_events import schemas
from entity_events.operators.enrich import Registry


def read_events(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Stored change events as a batch; of JSON, one event a line, see :func:`parse_events`."""
    if file_format == "json":
        return parse_events(spark.read.text(path))
    return spark.read.schema(schemas.CHANGE_EVENT).format(file_format).load(path)


def stream_events(
    spark: SparkSession, path: str, file_format: str = "json", **options: str
) -> DataFrame:
    """Change events as files arrive; options go to the file source."""
    reader = spark.readStream.options(**options)
    if file_format == "json":
        return parse_events(reader.text(path))
    return reader.schema(schemas.CHANGE_EVENT).format(file_format).load(path)


def parse_events(messages: DataFrame, column: str = "value") -> DataFrame:
    """Change events from JSON lines or message bodies, such as the ``value`` of a message broker source.

    No body is lost: one that is no JSON, has a field of another kind, or does not tell when the event was
    fired keeps its text in ``unreadable_line``, the other columns being null. Blank bodies hold nothing and
    give no row.
    """
    body = F.col(column).cast("string")
    kinds = T.StructType([*schemas.CHANGE_EVENT.fields, T.StructField("_rejected", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rejected"}
    parsed = messages.where(F.length(F.trim(body)) > 0).select(
        body.alias("_body"), F.from_json(body, kinds, options).alias("_event")
    )
    event = F.col("_event")
    readable = event["_rejected"].isNull() & event["time_fired"].isNotNull()
    return parsed.select(
        *(F.when(readable, event[name]).alias(name) for name in schemas.CHANGE_EVENT.names),
        F.when(~F.coalesce(readable, F.lit(False)), F.col("_body")).alias(schemas.UNREADABLE_LINE),
    )


def read_readings(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Stored readings that carry only the new state."""
    return spark.read.schema(schemas.READING).format(file_format).load(path)


def read_registry(spark: SparkSession, path: str, file_format: str = "parquet") -> Registry:
    """The four registry tables below a folder, as they are now."""
    kinds = {
        "entity": schemas.ENTITY,
        "device": schemas.DEVICE,
        "area": schemas.AREA,
        "floor": schemas.FLOOR,
    }
    tables = (
        spark.read.schema(schema).format(file_format).load(f"{path}/{name}")
        for name, schema in kinds.items()
    )
    return Registry(*tables)

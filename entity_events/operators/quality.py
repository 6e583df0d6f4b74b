"""Rules of the stored table as DataFrame operators, and rows that cannot be published."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events import schemas
from entity_events.functions import text
from entity_events.operators.skew import Lookup

UNKNOWN_ENTITY = "entity not found"
UNREADABLE = "attributes are not a JSON object"
UNREADABLE_LINE = "line is not a change event"


def first_per_point(documents: DataFrame) -> DataFrame:
    """Keep the first document of each point (stream, object id, timestamp); later ones conflict.

    Spark keeps one row of a point per task already before the shuffle, so a large group of copies never
    meets in one task.
    """
    point = Window.partitionBy(text.stream_name(F.col("data_stream")), "object_id", "timestamp").orderBy("seq")
    ranked = documents.withColumn("_rank", F.row_number().over(point))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def first_per_point_stream(documents: DataFrame, delay: str) -> DataFrame:
    """The streaming form: copies that arrive within ``delay`` of each other count once."""
    return (
        documents.withColumn("_stream", text.stream_name(F.col("data_stream")))
        .withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark(["_stream", "object_id", "timestamp"])
        .drop("_stream")
    )


def retained(documents: DataFrame, as_of: datetime, days: int = fixed.RETENTION_DAYS) -> DataFrame:
    """Documents young enough to be kept; on the stored table the date folders are pruned too."""
    oldest = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    kept = documents.where(F.col("timestamp") >= oldest)
    if "event_date" in documents.columns:
        kept = kept.where(F.col("event_date") >= oldest.cast("date"))
    return kept


def stream_constants(actions: DataFrame) -> DataFrame:
    """Per stream, whether type, dataset and namespace hold one value throughout."""
    parts = [F.col("_source.data_stream")[name] for name in ("type", "dataset", "namespace")]
    constant = F.lit(True)
    for part in parts:
        constant = constant & (F.min(part) == F.max(part))
    return actions.groupBy("_index").agg(
        F.count(F.lit(1)).alias("documents"), constant.alias("constant")
    )


def _unreadable() -> Column:
    given = F.col("attributes")
    return given.isNotNull() & F.from_json(given, "map<string,variant>").isNull()


def quarantined(readings: DataFrame, lookup: Lookup) -> DataFrame:
    """Readings that cannot become documents, each with an ``error``; they never stop the others.

    Feed lines that could not be read are among them, with their text in ``unreadable_line``.
    """
    known = lookup.with_rows(lookup.rows.select("entity_id", F.lit(True).alias("_known")))
    error = F.when(F.col("_known").isNull(), UNKNOWN_ENTITY).when(_unreadable(), UNREADABLE)
    if schemas.UNREADABLE_LINE in readings.columns:
        error = F.when(F.col(schemas.UNREADABLE_LINE).isNotNull(), UNREADABLE_LINE).otherwise(error)
    joined = known.join(readings, "left").withColumn("error", error)
    return joined.where(F.col("error").isNotNull()).drop("_known")


def readable(readings: DataFrame) -> DataFrame:
    """Readings whose attributes can be read; the rest are :func:`quarantined`."""
    return readings.where(~_unreadable())

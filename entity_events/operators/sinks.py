"""Writing documents: the append table, bulk text, and the outcome of a bulk append."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.functions import text
from entity_events.operators import manifest, quality
from entity_events.operators.documents import document_line
from entity_events.schemas import BULK_RESPONSE
from entity_events.sources import folders


def envelope(documents: DataFrame) -> DataFrame:
    """One action per document: operation, target stream, and the document itself."""
    return documents.select(
        F.lit(fixed.CREATE).alias("_op_type"),
        text.stream_name(F.col("data_stream")).alias("_index"),
        F.struct("*").alias("_source"),
    )


def bulk_text(documents: DataFrame) -> DataFrame:
    """Bulk request text, one row per document: the action line and the flat document line."""
    target = F.struct(text.stream_name(F.col("data_stream")).alias("_index"))
    action: Column = F.to_json(F.struct(target.alias(fixed.CREATE)))
    return documents.select(F.concat(action, F.lit("\n"), document_line(documents)).alias("value"))


def table_layout(documents: DataFrame) -> DataFrame:
    """Documents with the partition columns of the table, gathered and sorted for writing.

    Rebalancing collects the rows of a stream and day into few files and, being adaptive, splits a
    stream and day that is too large for one task.
    """
    laid_out = documents.withColumns({"dataset": _dataset(), "event_date": _day()})
    generation = [name for name in documents.columns if name == "generation"]
    return laid_out.hint("rebalance", "dataset", "event_date").sortWithinPartitions(
        *generation, "dataset", "event_date", "object_id", "timestamp"
    )


def _dataset() -> Column:
    return F.col("data_stream.dataset")


def _day() -> Column:
    return F.col("timestamp").cast("date")


@dataclass(frozen=True)
class Outcome:
    """What an append did: documents created, refused because their point was there, and without a point."""

    created: int
    refused: int
    failed: int


@dataclass(frozen=True)
class Touched:
    """The days that a batch has of one stream."""

    stream: str
    dataset: str
    days: tuple[date, ...]

    def ranges(self) -> list[tuple[date, date]]:
        """The days as stretches without a gap."""
        found: list[tuple[date, date]] = []
        for day in sorted(self.days):
            if found and day - found[-1][1] <= timedelta(days=1):
                found[-1] = found[-1][0], day
            else:
                found.append((day, day))
        return found

    def condition(self) -> Column:
        """The folders of these days, in a form that prunes the stored table when it is planned."""
        days = [F.col("event_date").between(F.lit(a), F.lit(b)) for a, b in self.ranges()]
        return (F.col("dataset") == self.dataset) & reduce(or_, days)


def touched_by(documents: DataFrame) -> tuple[list[Touched], int, int]:
    """Streams and days of a batch, and how many documents have a point and how many have none.

    One aggregate that reads three columns; its rows are one for each stream of the batch.
    """
    complete = _complete()
    rows = (
        documents.groupBy(text.stream_name(F.col("data_stream")).alias("stream"), _dataset().alias("dataset"))
        .agg(
            F.collect_set(F.when(complete, _day())).alias("days"),
            F.count_if(complete).alias("complete"),
            F.count_if(~complete).alias("failed"),
        )
        .collect()
    )
    touched = [Touched(row["stream"], row["dataset"], tuple(row["days"])) for row in rows if row["days"]]
    return touched, sum(row["complete"] for row in rows), sum(row["failed"] for row in rows)


def _complete() -> Column:
    parts = (F.col("timestamp"), F.col("object_id"), text.stream_name(F.col("data_stream")))
    return reduce(and_, (part.isNotNull() for part in parts))


def append(documents: DataFrame, path: str, generation: int | None = None) -> Outcome:
    """Append documents to the table: one folder per generation, stream and day.

    A point (stream, object id, timestamp) is created once, whatever generation it is in: of several
    documents the first counts, and one that the table has already is left as it is, so appending a batch
    again adds nothing and tells that all were refused. For that, only the point columns of the folders of the
    streams and days that the batch has are read. A document without one of the three is counted as failed.

    Without a generation, each stream is written to its own, which the table's manifest records from the
    stream's first document on. What was created is counted in the table, before and after; with two
    appends to the same days at a time those counts overlap.
    """
    spark = documents.sparkSession
    touched, complete, failed = touched_by(documents)
    if not touched:
        return Outcome(0, 0, failed)
    fresh = documents.where(_complete())
    stored = stored_points(spark, path, touched)
    before = 0
    if stored is not None:
        before = stored.count()
        same = (
            (_dataset() == F.col("_dataset"))
            & (_day() == F.col("_day"))
            & (F.col("object_id") == F.col("_object"))
            & (F.col("timestamp") == F.col("_time"))
        )
        # Before the sort that picks the first of a point, so that what is there already is not sorted.
        fresh = fresh.join(stored, same, "left_anti")
    fresh = quality.first_per_point(fresh)
    if generation is None:
        writing = manifest.join_streams(spark, manifest_path(path), [each.stream for each in touched])
        number = F.create_map(*(F.lit(x) for pair in writing.items() for x in pair))[
            text.stream_name(F.col("data_stream"))
        ]
    else:
        number = F.lit(generation)
    _write(fresh.withColumn("generation", number), path, "append", "generation")
    created = stored_points(spark, path, touched).count() - before
    return Outcome(created, complete - created, failed)


def manifest_path(path: str) -> str:
    """Where a table keeps its manifest."""
    return f"{path}/_manifest"


def stored_points(spark: SparkSession, path: str, touched: Sequence[Touched]) -> DataFrame | None:
    """Points that the table has in the given streams and days, over all generations; None without a table."""
    kinds = "object_id string, timestamp timestamp, generation int, dataset string, event_date date"
    try:
        stored = spark.read.schema(kinds).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.where(reduce(or_, (each.condition() for each in touched))).select(
        F.col("dataset").alias("_dataset"),
        F.col("event_date").alias("_day"),
        F.col("object_id").alias("_object"),
        F.col("timestamp").alias("_time"),
    )


def drop_expired(spark: SparkSession, path: str, as_of: datetime, days: int = fixed.RETENTION_DAYS) -> list[str]:
    """Delete the table's date folders that hold only documents :func:`quality.retained` would leave out.

    Folders are chosen by name; none is read and no file is rewritten. Doing it again drops nothing more.
    """
    oldest = (as_of - timedelta(days=days)).astimezone(UTC).date()
    dropped = []
    for generation in folders.values(spark, path, "generation"):
        for dataset in folders.values(spark, f"{path}/generation={generation}", "dataset"):
            above = f"generation={generation}/dataset={dataset}"
            for day in folders.values(spark, f"{path}/{above}", "event_date"):
                if date.fromisoformat(day) < oldest:
                    folders.drop(spark, f"{path}/{above}/event_date={day}")
                    dropped.append(f"{above}/event_date={day}")
    return dropped


def replace_part(documents: DataFrame, path: str) -> None:
    """Write documents as the whole content of a folder; writing it again changes nothing."""
    _write(documents, path, "overwrite")


def _write(documents: DataFrame, path: str, mode: str, *above: str) -> None:
    (
        table_layout(documents)
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy(*above, "dataset", "event_date")
        .parquet(path)
    )


def bulk_items(responses: DataFrame, column: str = "response") -> DataFrame:
    """One row per item of each bulk response, with its outcome."""
    parsed = responses.withColumn("_parsed", F.from_json(column, BULK_RESPONSE)).drop(column)
    placed = parsed.select(
        *(c for c in parsed.columns if c != "_parsed"),
        F.posexplode("_parsed.items").alias("position", "_item"),
    )
    named = placed.select(
        *(c for c in placed.columns if c != "_item"), F.explode("_item").alias("operation", "_outcome")
    )
    outcome = F.col("_outcome")
    return named.select(
        *(c for c in named.columns if c != "_outcome"),
        outcome["status"].between(200, 299).alias("ok"),
        outcome["status"].alias("status"),
        outcome["_index"].alias("index"),
        outcome["error"]["type"].alias("error_type"),
        outcome["error"]["reason"].alias("error_reason"),
    )


def outcome_counts(items: DataFrame, by: str = "batch_id") -> DataFrame:
    """Documents published and failed per batch; a batch without items has no row."""
    return items.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
    )

"""Publishing as a stream: gather, classify, poll, filter, format and append per micro-batch.

Readings without a reason are classified against the newest one of their entity, which the stream keeps as state;
a batch costs only the entities it has readings of. The rest of a micro-batch runs the batch operators. Everything a
batch writes goes into folders named after the query and the batch, as a whole, so a batch that is run again after
a failure replaces its own output: each document is stored once. Offsets are committed only after the batch has been
written, so nothing is lost while the output cannot be reached.

Only a poll needs the newest readings of all entities. With polls, a batch writes the newest readings of its own
entities next to the output; one with a tick reads these parts, and writes the whole in their place.

A stream keeps one folder per batch; :func:`fold` moves them into the table, each batch once.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from entity_events import schemas
from entity_events.functions import attributes as attrs
from entity_events.operators import changes as ops
from entity_events.operators import filters, quality, sinks
from entity_events.operators.enrich import ENTITIES_IN_TASK, Registry, details_lookup, entity_details
from entity_events.operators.skew import Lookup
from entity_events.plans.publish import Hook, publish
from entity_events.session import configure
from entity_events.settings import Settings, StaticFields
from entity_events.sources import folders
from entity_events.streaming import keyed

_CHANGE, _TICK = "change", "tick"
_WHOLE, _PART = "whole", "part"
_ADAPTIVE = "spark.sql.adaptive.enabled"
_UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"


def ticks(spark: SparkSession, seconds: int) -> DataFrame:
    """A row when the stream first starts, and one at each multiple of ``seconds`` on the wall clock.

    A stream that was down gets the ticks of that time when it starts again.
    """
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    at = F.date_trunc("second", "timestamp").alias("time")
    return rate.select(at, "value").where((F.unix_seconds("time") % seconds == 0) | (F.col("value") == 0)).select("time")


@contextmanager
def _switched_on(spark: SparkSession, setting: str) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _adaptive(spark: SparkSession) -> AbstractContextManager[None]:
    """Re-planning at run time for what a batch writes.

    Spark turns it off in the session of a stream with state, and then leaves out the rebalancing before a write: each
    task opens a file for every stream and day. The stream itself plans its next batch without it again.
    """
    return _switched_on(spark, _ADAPTIVE)


def _unloading(spark: SparkSession) -> AbstractContextManager[None]:
    """A stream that is started meanwhile has a part of its state in memory only while a task works on that part.

    Otherwise executors hold all of it, some 400 bytes for each point of ``first_within``. Each batch reads the state
    from the checkpoint, which tasks keep short by snapshots; it goes through all points anyway, to forget old ones.
    """
    return _switched_on(spark, _UNLOAD)


class _Newest:
    """The newest reading of every entity, as a whole up to some batch and parts of the batches after it."""

    def __init__(self, spark: SparkSession, folder: str, query_id: str):
        self.spark = spark
        self.root = f"{folder}/latest/query_id={query_id}"

    def _batches(self, kind: str, below: int) -> list[int]:
        found = map(int, folders.values(self.spark, f"{self.root}/kind={kind}", "batch_id"))
        return sorted(each for each in found if each < below)

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/kind={kind}/batch_id={batch_id}"

    def before(self, batch_id: int) -> DataFrame:
        """What is known before a batch; an entity may have several rows, one for each part."""
        last = max(self._batches(_WHOLE, batch_id), default=-1)
        paths = [self._path(_PART, each) for each in self._batches(_PART, batch_id) if each > last]
        if last >= 0:
            paths.append(self._path(_WHOLE, last))
        if not paths:
            return self.spark.createDataFrame([], schemas.READING)
        return self.spark.read.schema(schemas.READING).parquet(*paths)

    def write(self, readings: DataFrame, kind: str, batch_id: int) -> None:
        newest = ops.latest_state(readings).select(*schemas.READING.names)
        newest.write.mode("overwrite").parquet(self._path(kind, batch_id))

    def tidy(self, batch_id: int) -> None:
        """Drop what no batch from the last but one whole on needs, should it be run again."""
        last = max(self._batches(_WHOLE, batch_id), default=-1)
        for kind in (_WHOLE, _PART):
            for each in self._batches(kind, last):
                folders.drop(self.spark, self._path(kind, each))


def start(
    changes: DataFrame,
    folder: str,
    registry: Callable[[], Registry],
    settings: Settings | None = None,
    static: StaticFields | None = None,
    poll_ticks: DataFrame | None = None,
    available_now: bool = False,
    first_within: str | None = None,
    hooks: Sequence[Hook] = (),
) -> StreamingQuery | None:
    """Start publishing a stream of readings into ``folder``; None where publishing is off.

    ``changes`` has the columns of a reading, and ``reason`` where the feed tells it; otherwise
    readings are classified against the one before. ``poll_ticks`` has one ``time`` per poll; at each
    the current state of every entity is published too. ``registry`` is read again for each batch, so
    edits show up. ``available_now`` processes what is there and stops. With ``first_within``, such as
    ``"1 hour"``, copies of a reading that arrive within that time are left out across batches. ``hooks`` are
    applied to the documents in their order.
    """
    settings = settings or Settings()
    if settings.publish_seconds == 0:
        return None
    configure(changes.sparkSession)
    line = [name for name in changes.columns if name == schemas.UNREADABLE_LINE]
    known_reason = ["reason"] if "reason" in changes.columns else []
    rows = changes.select(*schemas.READING.names, *known_reason, *line)
    if first_within:
        rows = keyed.first_arrivals(rows, first_within)
    if settings.change_types and not known_reason:
        rows = keyed.classified(rows)
    rows = rows.withColumn("kind", F.lit(_CHANGE))
    polling = poll_ticks is not None and settings.poll_seconds > 0
    if polling:
        tick_rows = poll_ticks.select("time", F.lit(_TICK).alias("kind"))
        rows = rows.unionByName(tick_rows, allowMissingColumns=True)

    started = threading.Event()
    query_id: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        batch.persist()
        try:
            newest = _Newest(batch.sparkSession, folder, query_id[0]) if polling else None
            part = f"query_id={query_id[0]}/batch_id={batch_id}"
            with _adaptive(batch.sparkSession):
                _publish_batch(batch, batch_id, folder, part, registry(), settings, static, newest, hooks)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{settings.publish_seconds} seconds")
    # A query takes the settings of the moment it starts.
    with _unloading(changes.sparkSession) if first_within else nullcontext():
        query = writer.start()
    # The id survives restarts from the same checkpoint and is new for a new one.
    query_id.append(query.id)
    started.set()
    return query


def _publish_batch(
    batch: DataFrame,
    batch_id: int,
    folder: str,
    part: str,
    registry: Registry,
    settings: Settings,
    static: StaticFields | None,
    newest: _Newest | None,
    hooks: Sequence[Hook],
) -> None:
    # Read once a batch: it is measured, and joined for targets, documents and the quarantine.
    details = entity_details(registry, ENTITIES_IN_TASK).persist()
    try:
        lookup = Lookup.measured(details, "entity_id")
        _publish_with(lookup, batch, batch_id, folder, part, settings, static, newest, hooks)
    finally:
        details.unpersist()


def _publish_with(
    lookup: Lookup,
    batch: DataFrame,
    batch_id: int,
    folder: str,
    part: str,
    settings: Settings,
    static: StaticFields | None,
    newest: _Newest | None,
    hooks: Sequence[Hook],
) -> None:
    spark = batch.sparkSession
    changes = batch.where(F.col("kind") == _CHANGE).drop("kind")
    readings = changes.where(F.col("entity_id").isNotNull())
    gathered = readings if settings.change_types else None
    ticked = False
    if newest:
        reading = readings.select(*schemas.READING.names)
        polls = batch.where(F.col("kind") == _TICK).select("time").distinct()
        ticked = not polls.isEmpty()
        if ticked:
            known = newest.before(batch_id).unionByName(reading)
            polled = ops.poll_at(filters.targeted(known, lookup, settings), polls)
            gathered = polled if gathered is None else ops.merge(gathered.select(*polled.columns), polled)
            newest.write(known, _WHOLE, batch_id)
        else:
            newest.write(reading, _PART, batch_id)

    # What was written is counted from what was written; a batch without documents counts none.
    stored = 0
    if gathered is not None:
        documents = publish(gathered, lookup, settings, static, hooks=hooks)
        sinks.replace_part(documents, f"{folder}/documents/{part}")
        stored = spark.read.schema(documents.schema).parquet(f"{folder}/documents/{part}").count()
        if settings.audit_attributes:
            audit = gathered.select(
                "entity_id", "time", "seq", F.inline(attrs.rejected(attrs.parse(F.col("attributes"))))
            )
            audit.write.mode("overwrite").parquet(f"{folder}/audit/{part}")
    refused = quality.quarantined(changes.drop("reason"), lookup)
    refused.write.mode("overwrite").parquet(f"{folder}/quarantine/{part}")
    failed = spark.read.schema(refused.schema).parquet(f"{folder}/quarantine/{part}").count()
    outcome = spark.createDataFrame([(stored, stored, failed)], "documents long, succeeded long, failed long")
    outcome.write.mode("overwrite").json(f"{folder}/outcomes/{part}")
    if ticked:
        newest.tidy(batch_id)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents published into ``folder`` so far; an empty table before the first."""
    try:
        return spark.read.parquet(f"{folder}/documents")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    nothing = [spark.createDataFrame([], kind) for kind in (schemas.ENTITY, schemas.DEVICE, schemas.AREA, schemas.FLOOR)]
    readings = spark.createDataFrame([], schemas.READING).withColumn("reason", F.lit(None).cast("string"))
    return publish(readings, details_lookup(Registry(*nothing)))


def fold(spark: SparkSession, folder: str, table: str) -> sinks.Outcome:
    """Append the documents of all finished batches that were not folded yet to the table.

    A batch is finished when its outcome is written, which comes last. The log of folded batches is written
    after the append, and a point is created once: if the job ends between the two, or half-way, the next one
    appends the same batches again and adds only what is missing. The batches' folders stay until
    :func:`drop_folded`.
    """
    pending = sorted(_finished(spark, folder) - _folded(spark, table))
    if not pending:
        return sinks.Outcome(0, 0, 0)
    parts = [f"{folder}/documents/query_id={q}/batch_id={b}" for q, b in pending]
    written = [part for part, (q, b) in zip(parts, pending) if b in folders.values(spark, f"{folder}/documents/query_id={q}", "batch_id")]
    outcome = sinks.Outcome(0, 0, 0)
    documents = _read_parts(spark, f"{folder}/documents", written)
    if documents is not None:
        outcome = sinks.append(documents, table)
    spark.createDataFrame(pending, _LOG).coalesce(1).write.mode("append").json(f"{table}/_folded")
    return outcome


def drop_folded(spark: SparkSession, folder: str, table: str) -> int:
    """Delete the document folders of batches that are in the table; returns how many."""
    there = {(q, b) for q in folders.values(spark, f"{folder}/documents", "query_id") for b in folders.values(spark, f"{folder}/documents/query_id={q}", "batch_id")}
    gone = sorted(there & _folded(spark, table))
    for query_id, batch_id in gone:
        folders.drop(spark, f"{folder}/documents/query_id={query_id}/batch_id={batch_id}")
    return len(gone)


_LOG = "query_id string, batch_id string"


def _finished(spark: SparkSession, folder: str) -> set[tuple[str, str]]:
    root = f"{folder}/outcomes"
    return {(q, b) for q in folders.values(spark, root, "query_id") for b in folders.values(spark, f"{root}/query_id={q}", "batch_id")}


def _folded(spark: SparkSession, table: str) -> set[tuple[str, str]]:
    try:
        return {tuple(row) for row in spark.read.schema(_LOG).json(f"{table}/_folded").distinct().collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def _read_parts(spark: SparkSession, root: str, paths: Sequence[str]) -> DataFrame | None:
    """Documents of some batches below ``root``; None where none of them has any."""
    if not paths:
        return None
    try:
        documents = spark.read.option("basePath", root).parquet(*paths)
        return documents.drop("query_id", "batch_id", "dataset", "event_date")
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None

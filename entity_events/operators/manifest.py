"""Which schema version the table has, and the generation each stream is writing to.

An append records each stream it writes to; an update of the schema moves the streams that fit the pattern.

The manifest is a small append-only table; the newest row of a name is its current state.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.schemas import MANIFEST

#: Name of the row that records the installed schema.
SCHEMA_NAME = f"{fixed.STREAM_TYPE}-{fixed.DATASET_PREFIX}"
INSTALL, UPDATE, KEEP = "install", "update", "keep"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The manifest table, empty where nothing has been written yet."""
    try:
        return spark.read.schema(MANIFEST).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current(manifest: DataFrame) -> DataFrame:
    """Newest row of each name."""
    newest = F.max(F.struct("generation", "schema_version")).alias("newest")
    return manifest.groupBy("name").agg(newest).select(
        "name", "newest.schema_version", "newest.generation"
    )


def with_action(state: DataFrame, version: int = fixed.SCHEMA_VERSION) -> DataFrame:
    """What each row needs: install without a version, update if it differs, else keep."""
    installed = F.col("schema_version")
    action = F.when(installed.isNull(), INSTALL).when(installed != version, UPDATE).otherwise(KEEP)
    return state.withColumn("action", action)


def _schema_row(manifest: DataFrame, version: int) -> Row | None:
    state = current(manifest.where(F.col("name") == SCHEMA_NAME))
    return with_action(state, version).first()


def schema_action(manifest: DataFrame, version: int = fixed.SCHEMA_VERSION) -> str:
    """Action for the schema itself; an absent row means it was never installed."""
    row = _schema_row(manifest, version)
    return row["action"] if row else INSTALL


def rolled_over(
    manifest: DataFrame,
    pattern: str = fixed.STREAM_PATTERN,
    version: int = fixed.SCHEMA_VERSION,
) -> DataFrame:
    """New rows for every stream whose name fits the wildcard: next generation, given version."""
    regex = "^" + ".*".join(map(re.escape, pattern.split("*"))) + "$"
    return current(manifest.where(F.col("name").rlike(regex))).select(
        "name", F.lit(version).alias("schema_version"), (F.col("generation") + 1).alias("generation")
    )


def join_streams(spark: SparkSession, path: str, streams: Sequence[str]) -> dict[str, int]:
    """The generation that each of the streams is written to; those that are new are recorded with their first.

    The record is made before anything is written, so a stream that has documents also has a row. The row of
    the schema gives the version that new streams begin with.
    """
    known = {row["name"]: row for row in current(read(spark, path)).where(F.col("name").isin(SCHEMA_NAME, *streams)).collect()}
    version = known[SCHEMA_NAME]["schema_version"] if SCHEMA_NAME in known else fixed.SCHEMA_VERSION
    new = [(name, version, 1) for name in streams if name not in known]
    if new:
        spark.createDataFrame(new, MANIFEST).coalesce(1).write.mode("append").json(path)
    return {name: known[name]["generation"] if name in known else 1 for name in streams}


def ensure_schema(spark: SparkSession, path: str, version: int = fixed.SCHEMA_VERSION) -> str:
    """Install or update the schema in the manifest at ``path``; returns what was done.

    An update also starts a new generation of every stream, so old and new layouts never mix.
    """
    manifest = read(spark, path)
    row = _schema_row(manifest, version)
    action = row["action"] if row else INSTALL
    if action != KEEP:
        generation = row["generation"] + 1 if row else 1
        rows = spark.createDataFrame([(SCHEMA_NAME, version, generation)], MANIFEST)
        if action == UPDATE:
            rows = rows.unionByName(rolled_over(manifest, version=version))
        rows.write.mode("append").json(path)
    return action

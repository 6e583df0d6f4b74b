"""Session settings the library relies on, and where it may write intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_REQUIRED = {
    # Times are instants; text forms are written in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Two attributes that normalise to one key: the later one stays.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Run-time re-planning: small sides become broadcasts, skewed joins and writes are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session the caller owns."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Return a fresh folder below the cluster's checkpoint folder.

    Where none is set, a session that runs on one machine takes its warehouse; any other is refused, since a folder of
    one machine would not be seen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/entity-events-{uuid.uuid4().hex}"

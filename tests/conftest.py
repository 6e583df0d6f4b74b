import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pytest
from pyspark.sql import SparkSession

from entity_events import schemas
from entity_events.operators.enrich import Registry
from entity_events.session import configure


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def make_registry(spark):
    """Build a registry from lists of dicts; fields that are not given are null."""

    def table(rows, schema):
        return spark.createDataFrame(
            [tuple(row.get(name) for name in schema.names) for row in rows], schema
        )

    def make(entities=(), devices=(), areas=(), floors=()):
        return Registry(
            table(entities, schemas.ENTITY),
            table(devices, schemas.DEVICE),
            table(areas, schemas.AREA),
            table(floors, schemas.FLOOR),
        )

    return make

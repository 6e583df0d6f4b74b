"""Every registered query against its SQL on the smallest supplied tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from entity_events.catalog.queries import QUERIES
from tests.crosscheck import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="supplied tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["entity_id", "bucket", "average", "lowest", "highest", "readings"]

"""Queries that SQL can express, against it; the guarded import; and queries on empty tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from entity_events.llm.oracles import ORACLES
from entity_events.llm.queries import QUERIES
from tests.crosscheck import compare, connect

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="supplied tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name) == ""


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", [*sorted(QUERIES), "pipeline"])
def test_empty_tables(spark, make, name):
    for table, schema in SCHEMAS.items():
        make.table(table, [], schema)
    rows = entry.queries()[name](spark, make.folder).collect()
    assert [row.conv_id for row in rows] == ([-7] if name.startswith("op9_") else [])


def test_nothing_else_imports_the_subpackage():
    code = (
        "import sys; sys.modules['entity_events.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; assert not any(n.startswith('op') for n in e.queries()), list(e.queries())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

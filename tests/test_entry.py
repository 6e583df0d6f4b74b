"""The entry point without what only its optional part needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["regex", "public_tokenizers", "numpy", "pyarrow", "corpus_pipeline", "entity_events.llm"])
def test_core_queries_stay(missing):
    code = (
        f"import sys, warnings; warnings.simplefilter('ignore'); sys.modules['{missing}'] = None\n"
        "import __spark_entry__ as e\n"
        "from entity_events.catalog.queries import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) and len(QUERIES) > 95, len(e.queries())\n"
        "assert set(e.oracle_sql()) <= set(QUERIES)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

"""The contract without the corpus operators."""

import subprocess
import sys

import pytest
from conftest import ROOT

from rangeload.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("hidden", ["xxhash", "tokenizers", "rangeload.llm", "corpus_pipeline", "public_tokenizers"])
def test_other_queries_are_there(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], said.stderr

"""The entry without the optional part."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT

CODE = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as E
names = set(E.queries())
assert set(E.oracle_sql()) <= names and "gold_fact_clicks" in names
print(any(n.startswith("op") for n in names), "pipeline" in names)
"""


@pytest.mark.parametrize("blocked", ["tierflow.llm", "corpus_pipeline", "zstandard", "ahocorasick", "public_tokenizers"])
def test_core_survives_a_missing_package(blocked):
    out = subprocess.run([sys.executable, "-c", CODE, blocked], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["False", "False"], out.stderr

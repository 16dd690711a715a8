"""The entry without its optional part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
SCRIPT = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {0!r} or name == {0!r}:
            raise ModuleNotFoundError("absent", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(k.startswith("op") and k[2].isdigit() for k in entry.queries()))
"""


@pytest.mark.parametrize("name", ["placaflow.llm", "corpus_pipeline", "sentencepiece", "xxhash", "public_tokenizers"])
def test_main_queries_need_no_optional_module(name):
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(name)], cwd=ROOT, capture_output=True, text=True, check=True)
    count, twins, optional = run.stdout.split()
    assert int(count) == int(twins) >= 130 and optional == "False"

"""The driver's contract with and without the training-data operators."""

import subprocess
import sys
from pathlib import Path

import pytest

from screenline.plans import catalog

ROOT = str(Path(__file__).resolve().parent.parent)
BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["screenline.llm", "corpus_pipeline", "regex", "xxhash", "public_tokenizers"])
def test_other_queries_stay(name):
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name, root=ROOT)], capture_output=True, text=True, timeout=120)
    queries, twins = map(int, out.stdout.split())
    assert queries >= len(catalog.queries()) and twins >= len(catalog.oracles())

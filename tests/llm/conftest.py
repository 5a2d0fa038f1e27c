import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
# Python workers find the package in the same place.
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)


@pytest.fixture
def docs(rows):
    """documents from (doc_id, text[, lang[, source]]), with further columns
    whose names the operators use inside."""

    def make(data):
        full = [(*d, *[None] * (4 - len(d))) for d in data]
        full = [(*d[:4], None if d[1] is None else len(d[1]), "x", 7, "y") for d in full]
        return rows(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, fp string, size int, component string",
        )

    return make

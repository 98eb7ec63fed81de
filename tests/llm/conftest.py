import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DOCS = "doc_id bigint, text string, source string, n_chars bigint, hash string, size string"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names operators use inside."""

    def make(rows):
        rows = [(*r, "s")[:3] for r in rows]
        return spark.createDataFrame([(i, t, s, len(t or ""), "x", "y") for i, t, s in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: null, empty, blank, beyond ASCII, very long, without breaks."""
    return [None, "", " \t\n\x0b ", "one", "one two", "É Ä ñ 😀 x", "word " * 30_000, "z" * 200_000, "a\n\nb\nb\n", "\x00\x1f \x85  q"]

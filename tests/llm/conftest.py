from __future__ import annotations

import pytest
from corpus_texts import TEXTS


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls, empty and long texts, repeated rows, tied ids, and columns whose names clash with inner ones."""
    rows = [(i, t, "s" if i % 3 else None, f"x{i}", i) for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "no id here", "t", None, 0), (4, "another text of the same id", "s", "y", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, node string, n_words long").repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)

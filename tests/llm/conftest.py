from __future__ import annotations

import pytest


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a table of documents with the columns of the given ones."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "src", len(t or "")) for i, t in rows],
            "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG",
        )

    return make

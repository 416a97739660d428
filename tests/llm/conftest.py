from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs."""

    def make(rows, extra=""):
        full = [(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS)

    return make

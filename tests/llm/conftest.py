"""Fixtures of the operator tests (the session is the suite's)."""

from __future__ import annotations

import pytest


@pytest.fixture
def docs_of(spark):
    """DataFrame of documents from (doc_id, text[, source]) tuples, with the other columns of the table."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return make

from __future__ import annotations

import pytest

WIDE = "doc_id long, text string, lang string, source string, n_chars long, fp string, size string, blob string, path string, component string, node string, llm_text string, llm_blob string, llm_hash string, llm_words string, row string, of_size string, text_hash string, spans string"


@pytest.fixture
def documents(spark):
    """Makes documents from (doc_id, text, lang, source), with further columns whose names the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, k, s, len(t or ""), *["x"] * 14) for i, t, k, s in rows], WIDE)

    return make


#: Nulls, empty and white-space texts, repeated rows, ties, and one long text.
EDGE = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "same words in here", "en", "b"), (4, "same words in here", "en", "b"),
    (5, "same words in here", "de", None), (None, "no id at all", "en", "a"), (None, None, None, None), (7, "é ü ß " * 40_000, "fr", "b"), (8, "12 34 !!", None, "c"),
]

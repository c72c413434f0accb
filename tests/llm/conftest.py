import pytest


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang, source, n_chars) with clashing extra columns."""
    def make(rows):
        full = [(r + (None,) * 4)[:4] for r in rows]
        data = [(d, t, lang, src, len(t or ""), 1, "x", 0) for d, t, lang, src in full]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, rep int, key string, row int")
    return make

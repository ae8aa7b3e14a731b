import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from a list of texts, or of (doc_id, text)."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)

    return make

import pytest


@pytest.fixture
def docs(spark):
    """Makes documents from (doc_id, text) rows, with the other columns filled in."""

    def make(rows):
        full = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long"
        )

    return make

"""Small tables of documents."""

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents of (id, text) pairs, with the columns of the table."""

    def make(pairs):
        rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-like rows (doc_id, text, ...) with further columns on demand."""
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return make

import pytest


@pytest.fixture
def docs(spark):
    """A table from texts, with ids 1, 2, ... and columns whose names clash with the operators' own."""

    def make(texts, first=1):
        rows = [(first + i, t, "en" if i % 2 else None, None, 0, "x", 7) for i, t in enumerate(texts)]
        schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, label STRING, row INT"
        return spark.createDataFrame(rows, schema)

    return make

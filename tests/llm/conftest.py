import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(rows):
        rows = [(k, t, "en", "src", None if t is None else len(t), 7, "x") for k, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, length long, piece string")

    return make

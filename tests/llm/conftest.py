import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents of (doc_id, text) pairs, in one language."""

    def make(rows, lang="en"):
        return spark.createDataFrame(
            [(i, text, lang, "s", None if text is None else len(text)) for i, text in rows], SCHEMA
        ).repartition(3)

    return make

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, class string, shard int, s string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with extra columns whose names clash with those the operators use inside."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t), "x", 7, "y") for i, t, s in rows], DOCUMENTS)
    return make

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, batch int, key string, node int"


@pytest.fixture
def documents(spark):
    """Makes a table of (doc_id, text), with columns whose names clash with ones the operators use."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", None, None, 0, "k", 1) for i, t in rows], SCHEMA)

    return make


LONG = " ".join(f"w{i % 911}x{i}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, LONG), (6, LONG), (None, "no id here"), (7, "a,b;c")]


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, repeated rows and copies."""
    return documents(ODD)


@pytest.fixture
def nothing(documents):
    return documents([])

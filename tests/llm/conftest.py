import pytest


@pytest.fixture
def docs(spark):
    """Null, empty, tied, repeated and very long rows, and a column whose name an operator might use."""
    texts = [(1, "The cat sat on the mat", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " the CAT\tsat on the mat\n", "en", "b"), (5, "word " * 30_000, "en", "b"), (None, "no id here", "fr", None), (6, "x", None, "c"), (6, "x", None, "c"), (7, "...", "en", "a")]
    return spark.createDataFrame([(*t, len(t[1] or ""), 9) for t in texts], "doc_id long, text string, lang string, source string, n_chars long, size int")


@pytest.fixture
def empty(docs):
    return docs.limit(0)

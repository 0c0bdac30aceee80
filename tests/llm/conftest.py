import pytest


@pytest.fixture
def docs(spark):
    """A table of documents from rows of (doc_id, text), with columns whose names the operators use inside."""

    def make(rows, **extra):
        rows = [(i, t, "en", extra.get("source", {}).get(i, "s"), None if t is None else len(t), "clash", "clash") for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, size string")

    return make


NASTY = [(1, "a b c"), (2, None), (3, ""), (4, "a  b\tc"), (5, "x" * 200_000), (None, "a b c"), (None, None), (6, "é 日本 🎉 " * 500), (7, "a b c"), (7, "a b c")]


@pytest.fixture
def nasty(docs):
    return docs(NASTY)

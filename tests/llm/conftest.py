import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, hash long, size long"


@pytest.fixture(scope="session")
def docs(spark):
    """(id, text, source) rows as documents, with extra columns whose names the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 7, 7) for i, t, s in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and blank texts, ties, repeated rows, null ids and sources, one long text."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return docs([(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two", "b"), (4, "one two", "b"), (5, "One TWO", "b"),
                 (None, "no id at all in this row", "c"), (6, long_text, "c"), (7, long_text, None), (8, "x" * 5000, "c"),
                 (9, "é中\U0001f600 ́  z", "b")])

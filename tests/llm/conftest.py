import pytest

from bundleflow.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 977} tail{i}" for i in range(40_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 63),
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 63),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \t\n ", "en", "a", 4),
        (5, long_text, "en", "b", len(long_text)),
        (None, "The quick brown fox jumps over the lazy dog near the river bank", "en", None, 63),
        (6, "one two", None, "c", 7),
        (7, "ONE two", "de", "c", 7),
        (8, "漢字 🙂 naïve café 12345 !!! ‹x›", "fr", "c", 28),
    ]
    docs = llm.createDataFrame(rows, SCHEMA)
    names = ["id", "key", "node", "sig", "kept", "score", "label", "size", "crc", "n_words", "rule", "more", "seed"]
    return docs.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], SCHEMA)

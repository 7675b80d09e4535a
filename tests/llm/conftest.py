import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the onou and ersh, " * 20_000


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENTS)
        for name in extra.split():
            frame = frame.selectExpr("*", f"'clash' AS {name}")
        return frame

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty, blank and very long texts, repeated rows, ties and a null id."""
    return make_docs([
        (1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"),
        (6, "a  b\tc\nd e"), (7, "日本語 \U0001f600"), (8, "12345 !!! ???"),
    ])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCUMENTS))

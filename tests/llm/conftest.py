import datetime

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use for their own columns
    T.StructField("fingerprint", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType()), T.StructField("row", T.LongType()),
    T.StructField("raw", T.DateType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) rows with extra columns of clashing names."""
    def make(rows, repeat=1):
        day = datetime.date(2024, 1, 1)
        return spark.createDataFrame(
            [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), "f", "s", 0.5, 7, 1, day)
             for i, t in rows] * repeat, DOCS)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, a repeated row and a very long text."""
    words = " ".join(f"w{i % 997}x{i * 7919 % 10007}" for i in range(60_000))
    return [(1, "One two three four five."), (1, "One two three four five."), (2, None), (3, ""), (4, " \n\t "),
            (None, "A text without an id."), (5, words), (6, words), (7, "é ñ 　 \U0001F600 İ ß"), (8, "a")]

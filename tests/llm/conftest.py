import pytest

#: Documents with nulls, empty texts, ties, repeated rows, and columns named like the operators' own.
ODD = [
    (5, "one two three four five six seven eight nine ten", "en", "a"),
    (5, "one two three four five six seven eight nine ten", "en", "a"),
    (7, None, None, None),
    (8, "", "en", "b"),
    (None, "one two three four five six seven eight nine ten", None, "a"),
    (None, " \t\n", "de", None),
    (11, "ONE two three four five six seven eight nine ten", "en", "b"),
    (12, "x", "de", "b"),
    (13, "1234 5678 !!", "de", "c"),
]


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents from (doc_id, text, lang, source), with columns that clash with names used inside."""

    def documents(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return frame.selectExpr("*", "length(text) AS n_chars", "1 AS key", "2 AS mark", "'x' AS n", "3 AS slot", "4 AS size", "5 AS score", "6 AS class", "'y' AS `group`", "7 AS keys", "8 AS position", "9 AS s")

    return documents


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([])


@pytest.fixture(scope="session")
def sample(spark):
    """The whole table of documents at the smallest size."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

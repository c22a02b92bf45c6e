import pytest

ROWS = [
    (1, "The quick brown fox says that this is a sentence in English and nothing else.", "en", "a"),
    (2, "Der schnelle braune Fuchs sagt, dass dies ein Satz auf Deutsch ist und nichts anderes.", "de", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \n\t ", None, "b"),
    (5, " \n\t ", None, "b"),
    (None, "a row without an id", "en", None),
    (None, "a row without an id", "en", None),
    (None, None, None, None),
    (6, "12345 !!! ???", "en", "c"),
    (7, "word " * 40_000 + "the end", "en", "c"),
    (8, "The quick brown fox says that this is a sentence in English and nothing else.", "en", "d"),
    (9, "日本語の文章です。ÀÉ ümlaut \U0001f600 text", "xx", "d"),
]


@pytest.fixture
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, and columns named like those the operators make."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    names = ["rank", "begin", "fp", "root", "kept", "score", "__n", "tokens", "piece", "size", "label", "x", "row", "head", "digest"]
    return df.selectExpr("*", *[f"'clash' AS {n}" for n in names])


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)

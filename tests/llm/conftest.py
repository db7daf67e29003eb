import pytest

ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "one two three four",
    "Equal text of some words, repeated here.",
    "Equal text of some words, repeated here.",
    "word " * 3000,
    "Ünïcode ß İ 日本語 \U0001f600 and\x0bmore\x1cwords",
]


@pytest.fixture
def odd_documents(spark):
    """Nulls everywhere, empty and long texts, repeated rows, columns with taken names."""
    rows = [(i, text, "en", "a", f"x{i}", i) for i, text in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here but a few words", None, None, None, None)] * 2
    rows += [(50, "the same row twice", "en", None, "y", 1)] * 2
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, score string, kept long"
    )


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")

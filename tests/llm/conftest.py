import pytest


@pytest.fixture
def docs_of(spark):
    def make(rows, extra=""):
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint" + extra)

    return make


ODD = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \t\r\n\x0b\x0c ", "en", "a", 7),
    (None, "one two three four five six", "en", "a", 1),
    (4, "one two three four five six", "en", "a", 1),
    (4, "one two three four five six", "en", "a", 1),
    (5, "one  two three\nfour five six", None, "b", 1),
    (6, "x" * 300_000, "de", "a", 1),
    (7, "wort " * 40_000, "de", "c", 1),
    (8, "▁ \U0001f389 日本語 é", "ja", "c", 1),
]


@pytest.fixture
def odd_rows():
    return list(ODD)

import pytest


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty, blank and long texts, repeated rows, and
    columns whose names the operators use themselves."""
    long = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \t\n\r\x0b\x0c ", "en", "a", 7),
        (None, "a text without a number", "en", None, None),
        (None, None, None, None, None),
        (4, long, "en", "a", len(long)),
        (5, "same row", "en", "a", 8),
        (5, "same row", "en", "a", 8),
        (6, "ünïcode line \x1c sep ﬁn 日本 😀", "xx", "b", 1),
    ]
    wide = "score double, kept boolean, n_words long, _row string, lang2 int"
    return spark.createDataFrame(
        [(*r, 0.5, True, 3, "x", 1) for r in rows], f"{DOCS}, {wide}"
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

import pytest

LONG = "wörd été <b>&amp;\n" * 9000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows,
    extra columns whose names the operators use inside."""
    rows = [
        (1, "One small text.", "en", "s", 1, 7, "x"), (2, "ONE small TEXT.", "en", "s", 1, 7, "x"),
        (2, "ONE small TEXT.", "en", "s", 1, 7, "x"), (3, None, None, None, None, None, None),
        (4, "", "en", "s", 0, 7, "x"), (None, "One small text.", "en", "s", 1, 7, "x"),
        (None, None, None, None, None, None, None), (5, LONG, "fr", "s", 9, 7, "x"),
        (6, LONG.upper(), "fr", "s", 9, 7, "x"), (7, LONG + "z", "fr", "s", 9, 7, "x"),
        (8, " \n\t ", "en", "s", 1, 7, "x"), (9, "Émile ÉMILE Émile", "fr", "s", 1, 7, "x"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id long, mark string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

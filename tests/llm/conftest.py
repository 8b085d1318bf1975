import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, part int"


@pytest.fixture
def docs(spark):
    """Rows with nulls everywhere, repeats, ties, an empty and a long text, and columns
    whose names operators use themselves."""
    rows = [
        (1, "The mit license, mail a.b@example.com now!", "en", "a"),
        (2, "The mit license, mail a.b@example.com now!", "en", None),
        (2, "The mit license, mail a.b@example.com now!", "en", None),
        (None, "un deux trois quatre cinq six sept", "fr", "b"),
        (None, None, None, None),
        (5, "", "en", "a"),
        (6, None, "fr", "b"),
        (7, "123 456 !!", None, "c"),
        (8, "naïve 🦊 text\n\tof words " * 3000, "en", "c"),
        (9, "un deux trois quatre cinq six sept", None, "b"),
    ]
    return spark.createDataFrame([(*row, 1, 2, "k", 3) for row in rows], DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)

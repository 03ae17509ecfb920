import pytest

LONG = "word and other words, again and again. " * 3000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with names of the library's own."""
    rows = [
        (1, "The same text of some words for all.", "en", 1), (2, "the SAME text of some words for all.", None, 2),
        (3, "The same text of some words for all.", "en", None), (3, "The same text of some words for all.", "en", None),
        (4, None, "fr", 4), (5, "", None, 5), (None, "a text without any id at all", "en", 6), (None, None, None, None),
        (6, "…!?", "en", 7), (7, LONG, "en", 8), (8, LONG + "end", "de", 9), (9, "Ünïcödé ﬁ İstanbul \x1c x　y <|endoftext|> é", "de", 10),
        (10, "short", "en", 11), (11, "short", "en", 12), (12, "1234 5678", "en", 13),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").coalesce(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")

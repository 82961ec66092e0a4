import pytest


@pytest.fixture
def docs(spark):
    """Builds a documents frame with a clashing extra column or two."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, __k string, h int"

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), 1, "x", 2) for i, t, s in rows]
        return spark.createDataFrame(full, schema)
    return make


NASTY = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, "one", "b"), (5, "one", "b"),
    (None, "one two three", "a"), (None, "one two three", None), (6, "word " * 30000, "a"),
    (7, "é ü\x0bß\x0c x\ry", "b"), (8, "a b c d e f g h i j\nk l m n o p q r s t u v", "c"),
]


@pytest.fixture
def nasty(docs):
    return docs(NASTY)


@pytest.fixture
def empty(docs):
    return docs([])

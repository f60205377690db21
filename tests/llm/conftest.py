import pytest


@pytest.fixture
def documents(spark):
    """Makes a table of documents from (doc_id, text) pairs, with columns of other names."""

    def make(*rows, extra=""):
        fields = "doc_id long, text string, lang string, source string, n_chars long" + extra
        full = [(i, t, "en", "s", len(t or ""), *(["x"] if extra else [])) for i, t in rows]
        return spark.createDataFrame(full, fields)

    return make


def words(seed, n):
    """Text of made-up words, the same for a seed."""
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(n))


@pytest.fixture
def prose():
    return words

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=80):
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from rows of (doc_id, text) or longer, in three partitions."""
    def make(rows):
        full = [(*r, *[None] * (5 - len(r))) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd():
    """Nulls everywhere, empty and blank texts, a repeated row, a long text, text that no word ends."""
    return [
        (None, prose(1), "en", "a", 1), (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", None, "b", 4),
        (4, prose(2), "en", None, 5), (4, prose(2), "en", None, 5), (5, "x" * 100_000, "de", "b", 6),
        (6, prose(3, 20_000), "en", "a", 7), (7, "é \x85   ü", "fr", "a", 7), (8, "1.2.3.4 a@b.c " * 50, "en", "b", 9),
    ]

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _norm string, digest string, salt int"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and clashing column names."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, long, passage = text(120), text(6000), text(70)
    rows = [
        (1, base, "en", "a", None, "x", "y", 1), (2, base, "en", "a", 3, None, None, None), (2, base, "en", "a", 3, None, None, None),
        (3, base + "  ", None, None, 0, "", "", 0), (4, None, "de", "b", 1, "q", "q", 2), (5, "", "de", "b", 1, "q", "q", 2), (None, base, "fr", "c", 1, "n", "n", 3),
        (6, " \t\n", None, "c", None, None, None, None), (7, long, "en", "é", 5, "l", "l", 5), (8, long + " tail", "en", "é", 5, "l", "l", 5),
        (9, text(40) + " " + passage + " " + text(40), "en", "a", 1, "", "", 0), (10, text(60) + " " + passage + "\n" + text(10), "en", "b", 1, "", "", 0),
        (11, "one", "en", "a", 1, "", "", 0), (12, "one", "en", "b", 1, "", "", 0), (13, "ONE", None, None, 1, "", "", 0), (None, None, None, None, None, None, None, None),
        (-14, passage, "en", "a", 1, "", "", 0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"

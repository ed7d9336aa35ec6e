import random

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows, and extra columns with clashing names."""
    r = random.Random(1)
    long = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(60_000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 7, "x"),
        (1, "one two three four five six seven", "en", "a", 7, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "a", 0, "x"),
        (4, " \n\t ", "en", "a", 4, "x"),
        (None, "no id here at all, it has none", "en", "b", 30, "y"),
        (5, long, "en", "b", len(long), "z"),
        (6, "É ß 日本語 😀 a@b.co +1 (555) 123-4567 1.2.3.4\n\nÉ", "fr", "b", 40, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string")

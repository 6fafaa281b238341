import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, row long, size long, component string, at long, key string"


def words(n, seed, letters="abcdefgh"):
    r = random.Random(seed)
    return ["".join(r.choice(letters) for _ in range(r.randint(1, 7))) for _ in range(n)]


def prose(n, seed):
    out = words(n, seed)
    return " ".join(w + ("." if i % 9 == 8 else "") + ("\n" if i % 40 == 39 else "") for i, w in enumerate(out))


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a frame of (doc_id, text, lang, source) rows with further columns whose names clash with inner ones."""

    def make(rows):
        filled = [(*r, None, "x")[:4] if len(r) < 4 else tuple(r) for r in rows]
        full = [(i, t, lang, source, None, "n", 1, 2, "c", 3, "k") for i, t, lang, source in filled]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, ties and a very long text."""
    long = prose(30_000, 1)
    return [
        (1, None, "en", "a"),
        (2, "", None, None),
        (3, " \n\t ", "en", "a"),
        (4, "one", "en", "b"),
        (5, long, "en", "a"),
        (6, long, "de", "b"),
        (7, prose(300, 2), "de", "b"),
        (7, prose(300, 2), "de", "b"),
        (8, prose(300, 2) + " tail", "de", None),
        (None, prose(80, 3), None, "a"),
        (None, None, "en", "c"),
        (10, "é日本 ☃ ‑ ok!\r\nline", "fr", "c"),
    ]

import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Deterministic invented documents: (doc_id, text)."""
    draw = random.Random(11)
    parts = "the an er tion ing ble ou st re en th nd ha ly wh or".split()
    word = lambda: "".join(draw.choice(parts) for _ in range(draw.randint(1, 3)))

    def make(n):
        return " ".join(word() + draw.choice(["", "", "", ".", ","]) for _ in range(n))

    return make


@pytest.fixture
def documents(spark):
    """Rows with nulls in any column, empty texts, repeated rows and columns whose names the operators use themselves."""

    def frame(texts, **extra):
        rows = [(i, t, None, "s", None, 1, "k", 0.5, 7) for i, t in texts]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node int, key string, score double, size int")

    return frame

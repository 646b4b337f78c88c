"""Documents with every oddity: nulls, empty and long texts, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

import pytest

WORDS = [f"{a}{b}" for a in ("ta", "ko", "mi", "lu", "re", "so", "vi", "ne") for b in ("ran", "del", "pos", "tix", "bum", "gal", "fen", "dor")]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, node string, key long, rank int"


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))


def as_documents(spark, rows):
    """rows: (doc_id, text, source); further columns clash with names the operators use."""
    return spark.createDataFrame(
        [(i, t, "en", s, 0 if t is None else len(t), 0.5, "x", 1, 2) for i, t, s in rows], DOCUMENTS
    )


@pytest.fixture(scope="session")
def odd_rows():
    long = prose(1, 6000)
    return [
        (1, prose(2, 120), "a"),
        (2, prose(2, 120), "b"),
        (2, prose(2, 120), "b"),
        (3, None, "a"),
        (4, "", None),
        (5, " \t\n ", "c"),
        (None, prose(3, 90), "c"),
        (None, prose(3, 90), None),
        (6, long, "a"),
        (7, long + " tail", "a"),
        (8, "word", "b"),
        (9, "!!! ???", "b"),
        (10, "Éa b 'quoted' — dash", "d"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return as_documents(spark, odd_rows)


@pytest.fixture(scope="session")
def none(spark):
    return as_documents(spark, [])

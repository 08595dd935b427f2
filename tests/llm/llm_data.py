"""Invented rows for the tests."""

from __future__ import annotations

import random

import pytest

TINY = "/root/testdata/sf0.001"

def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = lambda n: "".join(random.Random(n).choices(letters, k=3 + n % 7))
    return " ".join(made(rng.randrange(vocabulary)) for _ in range(words))


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use themselves.
    "score double, shard int, fp long, row_a long, term string, digest_a long, tokens long, topic string"
)


def doc(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None, 0.5, 7, 7, 7, "t", 7, 7, "x")


@pytest.fixture(scope="session")
def messy(spark):
    """NULLs in every column, empty and blank texts, a very long one, repeated rows and ids."""
    rows = [
        doc(1, None), doc(2, ""), doc(3, " \n\t "), doc(4, "one"), doc(5, "Two words"),
        doc(6, "İ Σίσυφος ÑANDÚ 'quoted' 12.5% don't"), doc(7, prose(7, 30000)),
        doc(8, prose(8, 60)), doc(8, prose(8, 60)), doc(8, prose(9, 60)), doc(9, prose(8, 60)),
        doc(None, prose(8, 60)), doc(None, None), (None,) * 13, doc(-3, "!!! ... ###"),
        doc(10, prose(10, 80), None, None), doc(2**62, "\u0000 null byte \U0001f600"),
    ]
    return spark.createDataFrame(rows, SCHEMA).coalesce(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

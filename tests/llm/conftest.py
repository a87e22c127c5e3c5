"""Small tables for the operators of ``starmart.llm``."""

from __future__ import annotations

import random

import pytest

WORDS = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "lo")]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


def edited(text: str, every: int) -> str:
    """Every so many words one is replaced."""
    words = text.split()
    words[every - 1 :: every] = [w + "x" for w in words[every - 1 :: every]]
    return " ".join(words)


# Null and blank texts, a null id, repeated rows, ties, a very long text.
def odd_documents() -> list[tuple]:
    return [
        (1, prose(1, 120)),
        (2, prose(1, 120)),
        (3, None),
        (4, ""),
        (5, "  \n\t "),
        (None, prose(2, 80)),
        (None, None),
        (6, "one"),
        (6, "one"),
        (7, prose(3, 30_000)),
        (8, "İß’ 𝒳 \x00 naïve ümlaut end"),
    ]


@pytest.fixture
def odd_docs(spark):
    """``odd_documents`` with columns whose names clash with those in use."""
    rows = [(i, t, "k", 1.0, "x", "y") for i, t in odd_documents()]
    kind = "doc_id BIGINT, text STRING, key STRING, score DOUBLE, spans STRING, id STRING"
    return spark.createDataFrame(rows, kind)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING")

"""Small tables with the cases every operator must take: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import random

import pytest

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "so", "ti", "vu", "ze") for b in ("bar", "den", "fil", "gom", "hut", "jas")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(rng.choice(WORDS) + "x" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def mixed_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with copies, near copies, nulls, empty and very long texts."""
    rng = random.Random(5)
    texts: list[str | None] = [None, "", " \t\n", "Ab", "ab", "one two", "ONE  two", "one two three"]
    for _ in range(40):
        base = sentence(rng, rng.choice([12, 40, 90, 150]))
        texts += [base, base.upper(), base] if rng.random() < 0.3 else [base]
        texts += [edited(rng, base, share) for share in (0.005, 0.02, 0.05, 0.15)]
    texts += [sentence(rng, 30_000), "é" * 5_000, "a" * 3_000, "💡 ok " * 50]
    rows = [(k, t, rng.choice(["xx", None]), "s", None) for k, t in enumerate(texts)]
    rows += [rows[10], rows[11]]
    return rows


DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
CLASHING = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, id LONG, a STRING, size INT, n INT, score DOUBLE, rep LONG"


@pytest.fixture(scope="session")
def mixed(spark, mixed_rows):
    return spark.createDataFrame(mixed_rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, mixed_rows):
    """The same rows with further columns named like those that operators make."""
    return spark.createDataFrame([(*r, None, None, None, None, None, None) for r in mixed_rows], CLASHING)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)

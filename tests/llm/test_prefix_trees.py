"""Removal of repeated passages against the definition, window by window."""

from __future__ import annotations

import random

import pytest

from termweave.llm import prefix_trees


def expected(rows: list[tuple], size: int) -> list[tuple]:
    """(id, n_words, n_removed, kept) of rows (id, text)."""
    words = [(t or "").encode().split() for _, t in rows]
    least: dict[tuple, int] = {}
    for (key, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - size + 1):
            if key is not None:
                window = tuple(w[i : i + size])
                least[window] = min(least.get(window, key), key)
    out = []
    for (key, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if key is not None and least[tuple(w[i : i + size])] < key:
                gone.update(range(i, i + size))
        out.append((key, len(w), len(gone), " ".join(x.decode() for i, x in enumerate(w) if i not in gone)))
    return out


def got(docs, size: int = 13) -> list[tuple]:
    return sorted(map(tuple, prefix_trees.remove_repeats(docs, size=size).collect()), key=str)


def table(spark, rows, parts: int = 4):
    return spark.createDataFrame([(*r, 1, "x", b"k") for r in rows], "doc_id LONG, text STRING, grp INT, id STRING, keys BINARY").repartition(parts)


def passages(seed: int) -> list[tuple]:
    """Texts of few words that share passages, one of them shared by most; nulls, repeated rows and ids."""
    rng = random.Random(seed)
    words = ["the", "The", "of", "in", "é", "💡", "a", "b", "c", *(f"w{i}" for i in range(30))]
    license_line = " ".join(rng.choice(words) for _ in range(25))
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 40))) for _ in range(8)]
    rows: list[tuple] = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (None, license_line), (None, license_line)]
    for k in range(150):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice([license_line, license_line, rng.choice(shared)]))
        rows.append((rng.choice([k - 40, k, 2**40 + k]), rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [rows[20], (rows[20][0], rows[30][1]), (-5, "the " * 300), (500, "the " * 40), (501, "x " + "the " * 13)]
    rows.append((600, " ".join(rng.choice(words) for _ in range(40_000)) + " " + license_line))
    return rows


@pytest.mark.parametrize("size", [13, 1, 2, 5])
def test_passages(spark, size):
    rows = passages(size)
    assert got(table(spark, rows), size) == sorted(expected(rows, size), key=str)


def test_one_group_and_many(spark, monkeypatch):
    rows = passages(9)
    want = sorted(expected(rows, 13), key=str)
    monkeypatch.setattr(prefix_trees, "GROUPS_A_PART", 1)
    monkeypatch.setattr(prefix_trees, "LEAST_COUNT", 1_000)
    assert got(table(spark, rows)) == want
    monkeypatch.setattr(prefix_trees, "LEAST_COUNT", 1)
    monkeypatch.setattr(prefix_trees, "PART_BYTES", 50)
    monkeypatch.setattr(prefix_trees, "DEALT", 100)
    assert got(table(spark, rows)) == want


def test_mixed(mixed, mixed_rows, clashing):
    want = sorted(expected([(r[0], r[1]) for r in mixed_rows], 13), key=str)
    assert got(mixed) == want
    assert got(clashing) == want


def test_empty(empty):
    assert got(empty) == []

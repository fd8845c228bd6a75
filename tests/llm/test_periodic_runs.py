"""Periodic runs against the definition, word by word."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from termweave.llm import periodic_runs, queries

SF_DIR = "/root/testdata/sf0.001"


def runs_of(words: list, least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period), by checking every period: the smallest period of a maximal stretch."""
    n, found = len(words), {}
    values = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if words else np.empty(0)
    for q in range(1, n // repeats + 1):
        same = np.concatenate([[False], values[:-q] == values[q:], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if b - a + q >= max(least, repeats * q):
                found.setdefault((int(a), int(b + q)), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def split(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def kept(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_grammar_extends_as_far_as_symbols_are_equal():
    rng = np.random.default_rng(3)
    for alphabet in (1, 2, 3, 20):
        words = rng.integers(1, alphabet + 1, 300).astype(np.uint64)
        words[150:250] = words[20:120]
        symbols = np.concatenate([[np.uint64(10**9)], words, [np.uint64(10**9 + 1)]])
        fixed = np.zeros(symbols.size, bool)
        fixed[[0, -1]] = True
        grammar = periodic_runs.Grammar(symbols, fixed)
        x, y = rng.integers(1, 301, (2, 2000))
        x, y = x[x != y], y[x != y]
        ahead, behind = grammar.extension(x, y, 1), grammar.extension(x, y, -1)
        for a, b, up, down in zip(x.tolist(), y.tolist(), ahead, behind, strict=True):
            i = 0
            while symbols[a + i] == symbols[b + i]:
                i += 1
            j = 0
            while symbols[a - j] == symbols[b - j]:
                j += 1
            assert (up, down) == (i, j)


def texts() -> list[str | None]:
    rng = random.Random(7)
    out: list[str | None] = [None, "", " \t\n", "a", "a " * 23, "a " * 24, "A a " * 12, "b " + "a " * 2000, "a b " * 11 + "a c"]
    for _ in range(60):
        words = []
        while len(words) < rng.choice([10, 60, 200]):
            piece = [rng.choice("abcd") for _ in range(rng.randint(1, 12))]
            words += piece * rng.choice([1, 1, 2, 3, 5]) + piece[: rng.randint(0, len(piece))]
        out.append(" ".join(words))
    line = [f"w{i}" for i in range(400)]
    out += [" ".join(line * 3), " ".join(line * 3 + line[:7]), " ".join(line * 2 + line[:399]), " ".join(rng.choice("ab") for _ in range(3000))]
    out.append(" ".join(f"v{rng.randint(0, 10**6)}" for _ in range(5_000)) + " x y z" * 300)
    return out


def test_runs_are_those_of_the_definition(spark):
    rows = [(k % 50 if k % 9 else None, t, "clash", k) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, runs STRING, n_words INT").coalesce(1)
    got = periodic_runs.find_runs(docs).collect()
    assert len(got) == len(rows)
    for row, (key, text, *_) in zip(got, rows, strict=True):
        words = split(text)
        want = runs_of(words)
        assert row["id"] == key and row["n_words"] == len(words)
        assert [tuple(r) for r in row["runs"]] == want
        assert row["collapsed"] == kept(words, want)


def test_other_limits(spark):
    docs = spark.createDataFrame(list(enumerate(texts()[:40])), "doc_id LONG, text STRING")
    for row in periodic_runs.find_runs(docs, least=4, repeats=3).collect():
        words = split(texts()[row["id"]])
        assert [tuple(r) for r in row["runs"]] == runs_of(words, 4, 3)


def test_small_groups_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SYMBOLS", 50)
    monkeypatch.setattr(periodic_runs, "QUERIES", 300)
    import pyarrow as pa

    found = periodic_runs.text_runs(pa.array(texts()[:50]), 24, 3)
    for k, text in enumerate(texts()[:50]):
        start, end, q = found.get(k, ([], [], []))
        assert [(int(a), int(b - a), int(p)) for a, b, p in zip(start, end, q, strict=True)] == runs_of(split(text))


def test_two_repeats_are_refused(empty):
    with pytest.raises(ValueError, match="3 or more"):
        periodic_runs.find_runs(empty, repeats=2)


def test_empty(empty):
    assert periodic_runs.find_runs(empty).collect() == []


def test_query_against_the_definition(spark):
    got = {r["doc_id"]: r.asDict() for r in queries.op11_periodic_runs(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    found = 0
    for doc in docs:
        words = split(doc["text"])
        h = zlib.crc32(str(doc["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_of(words)
        found += len(runs)
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        row = got[doc["doc_id"]]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *top)
        assert row["exponent_milli"] == (top[0] is not None and 1000 * top[1] // top[2] or None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept(words, runs).encode()).hexdigest()
    assert found > 10


@pytest.mark.parametrize("text", ["a b c " * 8, "x " * 30 + "y " * 30])
def test_strongest_run_is_exact(spark, text):
    row = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")).select(periodic_runs.strongest().alias("top")).first()
    runs = runs_of(split(text))
    assert tuple(row["top"]) == min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))

"""Spelling variants against a brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from termweave.llm import queries, spelling

SF_DIR = "/root/testdata/sf0.001"


def deletions(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def near(x: str, y: str) -> bool:
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) - len(x) == 1 and x in deletions(y)


def expected(counts: dict[str, int], factor: int = 10) -> dict[str, tuple]:
    """word -> (form, root, n, n_near, form_n). Words that share what is left without one code point are compared."""
    groups = defaultdict(set)
    for word in counts:
        for left in {word} | deletions(word):
            groups[left].add(word)
    partners = defaultdict(set)
    for group in groups.values():
        for x in group:
            partners[x] |= {y for y in group if y != x and near(x, y)}
    form = {}
    for word, n in counts.items():
        best = min(partners[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= factor * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out[word] = (form[word], root, n, len(partners[word]), counts.get(form[word]))
    return out


def found(df) -> dict[str, tuple]:
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def vocabulary(seed: int = 1) -> dict[str, int]:
    rng = random.Random(seed)
    words: dict[str, int] = {}
    for _ in range(60):
        word = "".join(rng.choice("abcé") for _ in range(rng.randint(1, 14)))
        words[word] = rng.choice([1, 3, 40, 5000])
        for _ in range(12):
            k = rng.randrange(len(word))
            other = rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice("abcé") + word[k:], word[:k] + rng.choice("abcé") + word[k + 1 :]])
            words.setdefault(other, rng.choice([1, 2, 3, 30, 400]))
    return words


def test_words_against_all_pairs(spark):
    words = vocabulary()
    got = found(spelling.variants(spark.createDataFrame(list(words.items()), "word STRING, n LONG").repartition(3)))
    assert got == expected(words)
    for word, (_, _, _, n_near, _) in got.items():
        assert n_near == sum(near(word, other) for other in words)


@pytest.mark.parametrize(("cell", "tile", "entries"), [(3, 2, 10), (40, 3, 7), (20_000, 1, 100)])
def test_hot_cells_are_split(spark, monkeypatch, cell, tile, entries):
    """Words with one start, one end, or both, whatever the sizes of cells and tiles."""
    for name, value in (("CELL", cell), ("TILE", tile), ("ENTRIES", entries)):
        monkeypatch.setattr(spelling, name, value)
    rng = random.Random(2)
    words = {f"prefix{''.join(rng.choice('abc') for _ in range(6))}": rng.choice([1, 10, 200]) for _ in range(80)}
    words |= {f"{''.join(rng.choice('abc') for _ in range(5))}suffixes": rng.choice([1, 10, 200]) for _ in range(60)}
    words |= {f"same{c}word": 5 for c in "abcdefghij"} | {"sameword": 60, "a": 1, "b": 1, "": 3, "é": 4, "éé": 50}
    got = found(spelling.variants(spark.createDataFrame(list(words.items()), "word STRING, n LONG").coalesce(1)))
    assert got == expected(words)


def test_very_long_words(spark):
    long = "ab" * 4000
    words = {long: 100, long[:-1]: 3, "b" + long: 2, long[:5000] + "x" + long[5001:]: 1, "abababab": 7, "abababa": 90}
    assert found(spelling.variants(spark.createDataFrame(list(words.items()), "word STRING, n LONG"))) == expected(words)


def test_chain_of_forms_and_ties(spark):
    words = {"aaaaaaab": 2, "aaaaaaa": 20, "aaaaaaac": 20, "baaaaaaa": 200, "baaaaaaaa": 2000, "baaaaaaac": 2000}
    got = found(spelling.variants(spark.createDataFrame(list(words.items()), "word STRING, n LONG")))
    assert got == expected(words)
    assert got["aaaaaaa"][1] == "baaaaaaaa"


def counted(docs: list[tuple], slip: int | None, least: int = 7) -> Counter:
    total: Counter = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                total[run] += 1
    return total


@pytest.mark.parametrize("slip", [None, 3, 31])
def test_counts(spark, mixed_rows, monkeypatch, slip):
    monkeypatch.setattr(spelling, "COUNTED", 50)
    texts = [(r[0], r[1]) for r in mixed_rows] + [(None, "ÀÉ×÷ÿ straßenbahn Straßenbahn naïveté İstanbul ſtraightforward"), (7, "a" * 5_000)]
    docs = spark.createDataFrame([(*t, 1, "n") for t in texts], "doc_id LONG, text STRING, n INT, word STRING")
    assert {r["word"]: r["n"] for r in spelling.count_words(docs, slip=slip).collect()} == counted(texts, slip)


def test_empty(spark, empty):
    assert spelling.variants(spelling.count_words(empty)).collect() == []


def test_query_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    words = {w: n for w, n in counted(docs, 31).items() if n >= 2}
    assert len(words) > 500
    assert found(queries.op12_spelling_variants(spark, SF_DIR)) == expected(words)

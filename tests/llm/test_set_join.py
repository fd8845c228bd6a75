"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from conftest import edited, sentence

from termweave.llm import arrays, set_join


def brute_force(rows: list[tuple], n: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    """id -> (set size, component) by comparing all pairs of sets."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets: dict[int, set] = {}
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (row[1] or "").translate(lower))
        sets[row[0]] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    root = {k: k for k in sets}

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: (len(v), find(k)) for k, v in sets.items()}


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 4, 5), (2, 1, 2)])
def test_components_are_those_of_all_pairs(mixed, mixed_rows, n, num, den):
    want = brute_force(mixed_rows, n, num, den)
    got = set_join.jaccard_components(mixed, n=n, num=num, den=den).collect()
    assert len(got) == len(mixed_rows)
    assert {r.id: (r.n_shingles, r.component) for r in got} == want


def family(seed: int, size: int, shares: tuple[float, ...]) -> list[tuple]:
    """Near copies of one text with edits at random places, some of them near copies of each other, and other texts among them."""
    rng = random.Random(seed)
    base = sentence(rng, 90)
    texts = [edited(rng, base, rng.choice(shares)) for _ in range(size)]
    texts += [edited(rng, rng.choice(texts), 0.01) for _ in range(size // 4)]
    texts += [sentence(rng, 40) + " " + " ".join(base.split()[:k]) for k in (20, 50, 80)]
    return [(k + 1, text) for k, text in enumerate(texts)]


@pytest.mark.parametrize("seed, num, den, block", [(1, 4, 5, 250), (2, 9, 10, 7), (3, 3, 5, 20)])
def test_families_of_near_copies(spark, monkeypatch, seed, num, den, block):
    monkeypatch.setattr(set_join, "GROUP_BLOCK", block)
    rows = family(seed, 120, (0.005, 0.01, 0.02, 0.04, 0.07))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    got = set_join.jaccard_components(docs, n=3, num=num, den=den).collect()
    assert {r.id: (r.n_shingles, r.component) for r in got} == brute_force(rows, 3, num, den)


def test_a_family_has_fewer_candidates_than_sets(spark, monkeypatch):
    """Candidate pairs of a family of near copies do not grow with the square of its size."""
    made = []
    stored = set_join.stored

    def counted(df, name):
        out = stored(df, name)
        if name in ("pairs", "visits"):
            made.append(out.count())
        return out

    monkeypatch.setattr(set_join, "stored", counted)
    rows = family(5, 800, (0.005, 0.01, 0.02, 0.04))
    set_join.jaccard_join(spark.createDataFrame(rows, "doc_id LONG, text STRING"), n=3, num=4, den=5)
    assert len(made) == 2 and max(made) < len(rows)


def test_extra_columns_with_clashing_names(clashing, mixed_rows):
    got = set_join.jaccard_components(clashing, n=3, num=90, den=100).collect()
    assert {r.id: (r.n_shingles, r.component) for r in got} == brute_force(mixed_rows, 3, 90, 100)


def test_empty_table_and_null_ids(spark, empty):
    assert set_join.jaccard_components(empty).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f")], "doc_id LONG, text STRING")
    assert {(r.id, r.component) for r in set_join.jaccard_components(rows).collect() if r.id is not None} == {(1, 1)}


def test_frequent_shingles_come_last_and_change_nothing():
    grams = np.sort(np.random.default_rng(1).integers(-(2**62), 2**62, 50))
    order = set_join.Order(np.array([grams[3], grams[0]]))
    assert set(order.prefix(grams, 48)) == set(grams) - {grams[0], grams[3]}
    assert order.prefix(grams, 49)[-1] == grams[3]


def test_words_are_runs_of_bytes_with_ascii_lowered():
    texts = pa.array(["Ä B\tc", None, "", "x\x0by"])
    found = [(k, len(s)) for k, s in arrays.shingle_sets(texts, 1)]
    assert found == [(0, 3), (1, 0), (2, 0), (3, 2)]
    one, two = (s for _, s in arrays.shingle_sets(pa.array(["AB cd", "ab CD"]), 2))
    assert (one == two).all()


def test_short_batches_change_nothing(spark, mixed, mixed_rows):
    """Lists and groups that go over the end of a batch are taken up in the next."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "13")
    try:
        got = set_join.jaccard_components(mixed, n=3, num=90, den=100).collect()
    finally:
        spark.conf.set(name, before)
    assert {r.id: (r.n_shingles, r.component) for r in got} == brute_force(mixed_rows, 3, 90, 100)

"""Operator 10: near duplicates among embeddings by an inverted multi-index.

The two halves of the unit vectors are quantised apart; a cell is a pair of centroids, so K
centroids a half give K * K cells. A vector lives in its nearest cell and visits further cells in
the order of multi-sequence traversal (rising sum of the two squared distances). How many it visits is measured:
the links of stated vectors to all rows are found by brute force in blocks, with more vectors until LINKED
have links, and the shortest traversal that meets TARGET of the links of a vector, on average over them, is taken. Where links are
too rare for that, it must also meet TARGET of copies turned to the threshold. If none is long enough, all
vectors share one cell, which is brute force in blocks. In a cell every visitor and resident is compared
with every resident in double precision; a pair that can be met in two cells is counted in one.

Vectors that are equal stand as one, with their number. A crowded cell is cut into blocks of residents,
and visitors go to each block, so no task holds more than a block. Of a block come out sums and a
spanning set of links, at most one a vector, never all pairs. Codebooks are fitted on a bounded sample;
every vector is indexed.

Null and zero vectors and vectors with null or non-finite components link with nothing and are components of their own. Vectors of
different lengths do not compare, so each length has an index of its own; they should be few. Rows with a null id are left out of linking. Ties between cells go
to the lower number. Rows that share an id are one node. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.store import components, stored

# Vectors from which the codebooks are fitted, and those whose links are found by brute force.
SAMPLE = 20_000
SAMPLE_NUMBERS = 4_000_000
PROBES = (256, 2_048, 16_384)
# Probes with links that are enough, and turned copies that are taken where they are fewer.
LINKED = 64
TURNED = 512
TARGET = 0.995
VISITS = (1, 2, 4, 8, 16, 32)
# Tried where those fall short; beyond them blocks of all vectors cost no more.
FURTHER = (64, 128, 256)
CENTROIDS = (8, 512)
# Residents of a block.
BLOCK = 2_000


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; the largest component is scaled to 1 first, so that no square is too large or too small."""
    vectors = vectors / np.abs(vectors).max(axis=1, initial=0, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def k_means(points: np.ndarray, k: int, turns: int = 12) -> np.ndarray:
    """k centroids, seeded far apart."""
    rng = np.random.default_rng(7)
    chosen = [int(rng.integers(len(points)))]
    gap = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(k, len(points)) and gap.max() > 0:
        chosen.append(int(rng.choice(len(points), p=gap / gap.sum())))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    centroids = points[chosen].copy()
    for _ in range(turns):
        at = distances(points, centroids).argmin(1)
        n = np.bincount(at, minlength=len(centroids))
        sums = np.stack([np.bincount(at, points[:, d], len(centroids)) for d in range(points.shape[1])], 1)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)[None]


@dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray
    visits: int = VISITS[0]

    def cells(self, vectors: np.ndarray, visits: int) -> np.ndarray:
        """The first `visits` cells of each unit vector in traversal order; -1 where there are no more.

        The first n pairs in the order of the sum lie among pairs (i, j) of ranks with (i + 1)(j + 1) <= n.
        """
        half = self.first.shape[1]
        one, two = distances(vectors[:, :half], self.first), distances(vectors[:, half:], self.second)
        by_one, by_two = one.argsort(1, kind="stable"), two.argsort(1, kind="stable")
        i, j = np.array([(a, b) for a in range(min(one.shape[1], visits)) for b in range(min(two.shape[1], visits // (a + 1)))]).T
        rows = np.arange(len(vectors))[:, None]
        a, b = by_one[:, i], by_two[:, j]
        total = one[rows, a] + two[rows, b]
        order = np.lexsort((a * two.shape[1] + b, total), axis=1)[:, :visits]
        found = (a * two.shape[1] + b)[rows, order]
        short = visits - found.shape[1]
        return np.pad(found, ((0, 0), (0, short)), constant_values=-1) if short > 0 else found


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _met_at(own: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Visits that a row of cells needs to meet `home`; one more than the longest traversal if it does not."""
    hit = own == home[:, None]
    return np.where(hit.any(1), hit.argmax(1) + 1, own.shape[1] + 1)


def fit(distinct: DataFrame, dim: int, threshold: float) -> Codebooks:
    """Codebooks and the length of the traversal, for distinct(id, embedding)."""
    n = distinct.count()
    # About so many rows, by hash, whatever the input; fewer of long vectors, so that the sample stays within 32 MB of numbers.
    share = min(1.0, min(SAMPLE, SAMPLE_NUMBERS // dim) / n)
    sample = distinct.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1)).toPandas()
    if not len(sample):
        sample = distinct.limit(1).toPandas()
    vectors = unit(np.array(sample["embedding"].tolist(), np.float64).reshape(-1, dim))
    k = int(np.clip(2 ** round(np.log2(max(np.sqrt(n) / 4, 1))), *CENTROIDS))
    half = dim // 2
    books = Codebooks(k_means(vectors[:, :half], k), k_means(vectors[:, half:], k))
    names = sample["id"].to_numpy(np.int64)
    for size in PROBES:
        chosen = np.arange(min(size, len(vectors)))
        found = _met(distinct, dim, books, vectors[chosen], names[chosen], threshold, VISITS[-1])
        if found["probe"].nunique() >= LINKED or size >= len(vectors):
            break
    # If every vector is a probe, these are all links.
    turned = found["probe"].nunique() < LINKED and len(chosen) < n
    for choices in (VISITS, FURTHER):
        if choices is FURTHER and len(found):
            chosen = np.sort(found["probe"].unique())
            found = _met(distinct, dim, books, vectors[chosen], names[chosen], threshold, choices[-1])
        measured = [found] if len(found) else []
        if turned:
            measured.append(_met_by_turned(books, vectors, threshold, choices[-1]))
        for visits in choices:
            if all(_share(m, visits) >= TARGET for m in measured):
                books.visits = visits
                return books
    return Codebooks(vectors[:1, :half], vectors[:1, half:])


def _share(met: pd.DataFrame, visits: int) -> float:
    """The share of the links of a probe that are met, on average over probes."""
    near = met["n"].where(met["visits"] <= visits, 0).groupby(met["probe"]).sum()
    return float((near / met["n"].groupby(met["probe"]).sum()).mean())


def _met_by_turned(books: Codebooks, vectors: np.ndarray, threshold: float, longest: int) -> pd.DataFrame:
    """(probe, visits, n) of TURNED vectors and copies of them, turned at random until the cosine is the threshold."""
    own = vectors[np.arange(TURNED) % len(vectors)]
    aside = np.random.default_rng(11).normal(size=own.shape)
    aside = unit(aside - (aside * own).sum(1, keepdims=True) * own)
    copies = threshold * own + np.sqrt(max(1 - threshold**2, 0)) * aside
    one, two = books.cells(own, longest), books.cells(copies, longest)
    met = np.minimum(_met_at(one, two[:, 0]), _met_at(two, one[:, 0]))
    return pd.DataFrame({"probe": np.arange(TURNED), "visits": met, "n": 1})


def _met(distinct: DataFrame, dim: int, books: Codebooks, probes: np.ndarray, names: np.ndarray, threshold: float, longest: int) -> pd.DataFrame:
    """(probe, visits, n): how many links each probe has that are met by so many visits; longest + 1 if by more."""
    shared = distinct.sparkSession.sparkContext.broadcast((books, probes, names))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, probes, names = shared.value
        probe_cells = np.concatenate([own.cells(probes[k : k + 512], longest) for k in range(0, len(probes), 512)])
        for batch in filter(len, batches):
            ids = batch.column(0).to_numpy()
            every = unit(_matrix(batch.column(1), dim))
            for begin in range(0, len(every), 512):
                here = every[begin : begin + 512]
                pairs = [np.nonzero(here @ probes[k : k + 2_048].T >= threshold) for k in range(0, len(probes), 2_048)]
                i = np.concatenate([p[0] for p in pairs])
                j = np.concatenate([p[1] + k * 2_048 for k, p in enumerate(pairs)])
                other = ids[begin + i] != names[j]
                i, j = i[other], j[other]
                if not i.size:
                    continue
                rows, at = np.unique(i, return_inverse=True)
                cells = own.cells(here[rows], longest)
                met = np.concatenate(
                    [
                        np.minimum(_met_at(cells[a], probe_cells[b, 0]), _met_at(probe_cells[b], cells[a, 0]))
                        for k in range(0, i.size, 8_192)
                        for a, b in [(at[k : k + 8_192], j[k : k + 8_192])]
                    ]
                )
                value, times = np.unique(j * (longest + 2) + met, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value // (longest + 2)), pa.array(value % (longest + 2)), pa.array(times)], ["probe", "visits", "n"])

    met = distinct.mapInArrow(count, "probe LONG, visits LONG, n LONG")
    return met.groupBy("probe", "visits").agg(F.sum("n").alias("n")).toPandas()


def _placed(books: Codebooks, dim: int, shared):
    """mapInArrow function: (id, n, embedding, cells) of (id, n, embedding)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in filter(len, batches):
            cells = own.cells(unit(_matrix(batch.column(2), dim)), own.visits)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * own.visits), pa.array(cells.ravel().astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "n", "embedding", "cells"])

    return read


def _compare(dim: int, visits: int, threshold: float):
    """mapInArrow function over (cell, salt, visitor, id, n, embedding, cells) in that order: sums of links and links.

    Residents of a block come first and are held; visitors, and the residents of the
    whole cell once more, are compared with them as they come.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: tuple | None = None
        held: list[dict[str, np.ndarray]] = []
        state: dict[str, np.ndarray] = {}

        def rows(kind: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(a.size, kind)), pa.array(a), pa.array(b)], ["is_link", "a", "b"])

        def close() -> Iterator[pa.RecordBatch]:
            if state:
                got = np.flatnonzero(state["links"])
                yield rows(False, state["id"][got], state["links"][got])
                tied = np.flatnonzero(state["root"] != np.arange(state["root"].size))
                yield rows(True, state["id"][tied], state["id"][state["root"][tied]])
            state.clear()
            held.clear()

        def compare(x: dict[str, np.ndarray], cell: int) -> Iterator[pa.RecordBatch]:
            if not state:
                if not held:
                    return
                state.update({k: np.concatenate([h[k] for h in held]) for k in held[0]})
                state["links"] = np.zeros(state["id"].size, np.int64)
                state["root"] = np.arange(state["id"].size)
            for begin in range(0, x["id"].size, 512):
                part = {k: v[begin : begin + 512] for k, v in x.items()}
                i, j = np.nonzero(part["vector"] @ state["vector"].T >= threshold)
                home = part["cells"][i, 0]
                at_home = home == cell
                twice = (state["cells"][j] == home[:, None]).any(1)
                once = np.where(at_home, part["id"][i] < state["id"][j], ~twice | (cell < home))
                i, j = i[once], j[once]
                links = np.bincount(i, state["n"][j], part["id"].size).astype(np.int64)
                np.add.at(state["links"], j, part["n"][i])
                got = np.flatnonzero(links)
                yield rows(False, part["id"][got], links[got])
                edges = np.searchsorted(i, np.append(got, part["id"].size))
                ends = []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    roots = np.unique(state["root"][j[a:b]])
                    if roots.size > 1:
                        state["root"][np.isin(state["root"], roots)] = roots[0]
                    ends.append(roots[0])
                yield rows(True, part["id"][got], state["id"][np.array(ends, np.int64)])

        for batch in filter(len, batches):
            cell, salt, visitor = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            x = {
                "id": batch.column(3).to_numpy(),
                "n": batch.column(4).to_numpy(),
                "vector": unit(_matrix(batch.column(5), dim)),
                "cells": batch.column(6).flatten().to_numpy().reshape(-1, visits),
            }
            change = np.flatnonzero((np.diff(cell) != 0) | (np.diff(salt) != 0) | (np.diff(visitor.astype(int)) != 0)) + 1
            bounds = [0, *change.tolist(), cell.size]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if block != (cell[a], salt[a]):
                    yield from close()
                    block = (cell[a], salt[a])
                part = {k: v[a:b] for k, v in x.items()}
                if not visitor[a]:
                    held.append(part)
                else:
                    yield from compare(part, int(cell[a]))
        yield from close()

    return read


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component, kept) of every row: links to other vectors with a cosine of `threshold` or more."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("embedding"))
    whole = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.coalesce(whole & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("id").isNotNull()
    alone = rows.where(~whole).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    found = [alone]
    for row in rows.where(whole).select(F.size("embedding").alias("dim")).distinct().orderBy("dim").collect():
        found.append(_of_length(rows.where(whole & (F.size("embedding") == row["dim"])), row["dim"], threshold, block))
    return _finish(reduce(DataFrame.unionByName, found))


def _of_length(fit_rows: DataFrame, dim: int, threshold: float, block: int) -> DataFrame:
    """(id, n_links, component) of usable vectors of one length."""
    if dim < 2:
        # One component: every pair has a cosine of 1 or -1.
        sign = fit_rows.select("id", (F.element_at("embedding", 1) > 0).alias("up"))
        sums = sign.groupBy("up").agg(F.min("id").alias("component"), (F.count_distinct("id") - 1).alias("n_links"))
        return sign.join(sums, "up").select("id", "n_links", "component")
    distinct = stored(fit_rows.groupBy("embedding").agg(F.min("id").alias("id"), F.count_distinct("id").alias("n")).select("id", "n", "embedding"), "vectors")
    members = fit_rows.join(distinct.withColumnRenamed("id", "rep"), "embedding").select("id", "rep", "n")
    books = fit(distinct.select("id", "embedding"), dim, threshold)
    shared = fit_rows.sparkSession.sparkContext.broadcast(books)
    placed = stored(distinct.mapInArrow(_placed(books, dim, shared), "id LONG, n LONG, embedding ARRAY<DOUBLE>, cells ARRAY<LONG>"), "placed")
    crowd = placed.groupBy(F.col("cells")[0].alias("cell")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("salts"))
    crowd = stored(crowd, "cells")
    # Residents: one block each. Visitors, and residents as such: every block of a cell that has residents.
    residents = placed.select(F.col("cells")[0].alias("cell"), "id", "n", "embedding", "cells").join(crowd, "cell")
    residents = residents.select("cell", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"), F.lit(False).alias("visitor"), "id", "n", "embedding", "cells")
    visitors = placed.select(F.explode("cells").alias("cell"), "id", "n", "embedding", "cells").where("cell >= 0").join(crowd, "cell")
    visitors = visitors.select("cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("visitor"), "id", "n", "embedding", "cells")
    both = residents.unionByName(visitors).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "visitor")
    found = stored(both.mapInArrow(_compare(dim, books.visits, threshold), "is_link BOOLEAN, a LONG, b LONG"), "found")
    links = found.where("NOT is_link").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("links"))
    tied = components(found.where("is_link").select("a", "b")).withColumnRenamed("id", "rep")
    return members.join(links, "rep", "left").join(tied, "rep", "left").select(
        "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )


def _finish(found: DataFrame) -> DataFrame:
    return found.select("id", "n_links", "component", F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))

"""Operator 12: words that differ by one code point, by dense prefix-suffix tiling, and the form that each is a variant of.

Words of lengths m and m, or m - 1 and m, differ by one edit if the code points that they share at the start and those that they
share at the end are m - 1 in all. So they agree on the first half of m, or else on the last half.

1. Cells: every word stands in the cells of its first and its last half, for m as its own length and as one more. A cell that
   is too large for a task is split: of what is not yet known to be equal, half is taken to the start or to the end. A
   pair goes to the end only if its common start is shorter than that, so every pair meets in one cell and no other. What is left
   of a word in the smallest cells is one code point, so their size is bounded by the alphabet.
2. Tiles: in its task a cell is split on in the same way down to tiles of at most TILE words, which are compared densely: the words of
   a tile are rows of two matrices of code points, padded at the end and at the start. The first difference of two rows gives
   the length of the common start or end.
3. Forms: of the near words the most frequent is a word's form if it is `factor` times as frequent. Along forms counts grow
   by that factor, so chains are short (a logarithm of the largest count) and are followed by joins that double their reach.

Null and empty texts have no words. Rows that repeat count again. Of words that are equally frequent the smallest in code-point order
comes first. An empty table gives an empty result. Extra columns are not read. A single word may be as long as its text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.store import stored

# Words of a cell that go to one task, and of a tile; entries and code points that a task compares at once.
CELL = 20_000
TILE = 64
ENTRIES = 50_000
COMPARED = 4_000_000
# Distinct words a task counts before it reports them.
COUNTED = 300_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, slip: int | None = None) -> DataFrame:
    """(word, n) of all words of at least `least` letters of Latin-1, A-Z in lower case.

    With `slip` every word of a document for which that number divides h, the CRC-32 of "id:word", loses its code point h % length,
    as if it had been mistyped; a row without an id has "" for it.
    """
    shape = re.compile(rf"[a-zÀ-ÿ]{{{least},}}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def report() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                if not value.is_valid:
                    continue
                found = Counter(shape.findall(value.as_py().encode().translate(_LOWER).decode()))
                if slip is None:
                    total.update(found)
                    continue
                begin = zlib.crc32(f"{name.as_py() if name.is_valid else ''}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), begin)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    total[word] += n
                if len(total) >= COUNTED:
                    yield report()
                    total.clear()
        if total:
            yield report()

    counted = docs.select(F.col(key).cast("long"), text).mapInArrow(read, "word STRING, n LONG")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _cells(words: DataFrame) -> DataFrame:
    """(m, a, b, most, word, n, cell) of words(word, n): the first a and last b code points are one cell's; `most` bounds the common start of its pairs."""
    size = F.char_length("word")
    both = words.withColumn("m", F.explode(F.array(size, size + 1))).withColumn("h", F.floor(F.col("m") / 2).cast("int"))
    sides = F.explode(F.array(F.struct(F.col("h").alias("a"), F.lit(0).alias("b"), F.col("m").alias("most")), F.struct(F.lit(0).alias("a"), F.col("h").alias("b"), F.col("h").alias("most"))))
    return _named(both.select("m", sides.alias("s"), "word", "n").select("m", "s.*", "word", "n"))


def _named(cells: DataFrame) -> DataFrame:
    start, end = F.expr("left(word, a)"), F.expr("right(word, b)")
    return cells.withColumn("cell", F.xxhash64("m", "a", "b", "most", start, end))


def _split(cells: DataFrame) -> DataFrame:
    """Cells by half of what is not yet known to be equal."""
    h = F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
    sides = F.explode(
        F.array(
            F.struct((F.col("a") + h).alias("a"), F.col("b").alias("b"), F.col("most").alias("most")),
            F.struct(F.col("a").alias("a"), (F.col("b") + h).alias("b"), F.least("most", F.col("a") + h).alias("most")),
        )
    )
    return _named(cells.select("m", sides.alias("s"), "word", "n").select("m", "s.*", "word", "n"))


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, code points padded at the end, and padded at the start) of words."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    kind = np.uint8 if points.max(initial=0) < 1 << 8 else np.uint16 if points.max(initial=0) < 1 << 16 else np.uint32
    width = int(size.max(initial=0))
    row = np.repeat(np.arange(size.size), size)
    column = np.arange(points.size) - np.repeat(np.cumsum(size) - size, size)
    ahead = np.zeros((size.size, width), kind)
    ahead[row, column] = points
    behind = np.zeros((size.size, width), kind)
    behind[row, width - size[row] + column] = points
    return size, ahead, behind[:, ::-1]


def _shared(rows: np.ndarray, x: np.ndarray, y: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Length of the common start of rows x and y, at most that of the shorter word."""
    differ = rows[x] != rows[y]
    first = differ.argmax(1)
    return np.where(differ[np.arange(x.size), first], np.minimum(first, shorter), shorter)


def near_pairs(m: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, cell: np.ndarray, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y): numbers of entries whose words differ by one edit, of whole cells."""
    entry = np.arange(cell.size)
    size, ahead, behind = _matrices(words)
    while entry.size:
        order = np.argsort(cell, kind="stable")
        entry, a, b, most, cell = (v[order] for v in (entry, a, b, most, cell))
        heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        count = np.diff(np.append(heads, cell.size))
        dense = (count <= TILE) | ((m[entry] - a - b)[heads] <= 1)
        # Each entry of a tile with all that follow.
        behind_it = np.repeat(heads + count, count) - np.arange(cell.size) - 1
        behind_it[~np.repeat(dense, count)] = 0
        total = np.cumsum(behind_it)
        first = 0
        while first < cell.size and total[-1]:
            most_pairs = max(1, COMPARED // max(1, ahead.shape[1]))
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + most_pairs, "right")))
            here = behind_it[first:last]
            left = np.repeat(np.arange(first, last), here)
            right = left + 1 + np.arange(left.size) - np.repeat(np.cumsum(here) - here, here)
            x, y = entry[left], entry[right]
            fits = np.maximum(size[x], size[y]) == m[x]
            left, x, y = left[fits], x[fits], y[fits]
            shorter = np.minimum(size[x], size[y])
            start = _shared(ahead, x, y, shorter)
            fits = start < most[left]
            x, y, start, shorter = x[fits], y[fits], start[fits], shorter[fits]
            near = start + _shared(behind, x, y, shorter) >= m[x] - 1
            if near.any():
                yield x[near], y[near]
            first = last
        stays = np.flatnonzero(~np.repeat(dense, count))
        entry, a, b, most, cell = (v[stays] for v in (entry, a, b, most, cell))
        half = (m[entry] - a - b) // 2
        entry, cell = np.tile(entry, 2), np.tile(cell, 2)
        a, b, most = np.append(a + half, a), np.append(b, b + half), np.append(most, np.minimum(most, a + half))
        names = [words[k] for k in entry.tolist()]
        keys = [xxhash.xxh3_64_intdigest(f"{c} {i} {j} {w[:i]} {w[len(w) - j :]}") for c, i, j, w in zip(cell.tolist(), a.tolist(), b.tolist(), names, strict=True)]
        cell = np.array(keys, np.uint64).view(np.int64)


NEAR = "word STRING, near STRING, near_n LONG"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over cells in order of (m, cell): both directions of all near pairs."""
    held: list[pa.RecordBatch] = []
    n = 0

    def solve(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        m, a, b, most, cell, n = (table.column(c).to_numpy().astype(np.int64) for c in ("m", "a", "b", "most", "cell", "n"))
        words = table.column("word").to_pylist()
        names = pa.array(words, pa.string())
        # Cells of very different lengths apart, so that no matrix is wide for one word.
        width = np.floor(np.log2(np.maximum(m, 1)) * 2).astype(np.int64)
        for first, last in zip(*_stretches(width), strict=True):
            # Cells of one word have no pair.
            own = slice(first, last)
            _, which, count = np.unique(cell[own], return_inverse=True, return_counts=True)
            at = first + np.flatnonzero(count[which] > 1)
            if not at.size:
                continue
            for x, y in near_pairs(m[at], a[at], b[at], most[at], cell[at], [words[k] for k in at.tolist()]):
                x, y = at[x], at[y]
                one, two = pa.array(np.append(x, y)), pa.array(np.append(y, x))
                yield pa.RecordBatch.from_arrays([names.take(one), names.take(two), pa.array(n[np.append(y, x)])], ["word", "near", "near_n"])

    for batch in filter(len, batches):
        held.append(batch)
        n += batch.num_rows
        if n < ENTRIES:
            continue
        # The last cell may go on in the next batch.
        table = pa.Table.from_batches(held).combine_chunks()
        cell = table.column("cell").to_numpy()
        cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if (cell != cell[-1]).any() else 0
        if cut:
            yield from solve(table.slice(0, cut).to_batches())
        held = table.slice(cut).to_batches()
        n = table.num_rows - cut
    if n:
        yield from solve(held)


def _stretches(values: np.ndarray) -> tuple[list[int], list[int]]:
    heads = np.flatnonzero(np.append(True, values[1:] != values[:-1])).tolist()
    return heads, [*heads[1:], values.size]


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): for each of words(word, n) those that differ by one inserted, deleted or replaced code point. Words are distinct."""
    open_, done = _cells(words), []
    while True:
        open_ = stored(open_, "cells")
        large = open_.groupBy("cell").count().where((F.col("count") > CELL)).select("cell")
        # Cells of more than CELL entries are at most one in CELL of them; the list is counted before it is sent.
        large = stored(large, "large")
        n = large.count()
        if not n:
            done.append(open_)
            break
        sent = F.broadcast(large) if n <= 100_000 else large
        rest = F.col("m") - F.col("a") - F.col("b")
        done += [open_.join(sent, "cell", "left_anti"), open_.where(rest <= 1).join(sent, "cell", "left_semi")]
        open_ = _split(open_.where(rest > 1).join(sent, "cell", "left_semi"))
    cells = done[0]
    for more in done[1:]:
        cells = cells.unionByName(more)
    cells = cells.repartition("cell").sortWithinPartitions("m", "cell")
    return cells.mapInArrow(_compare, NEAR)


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of distinct words(word, n)."""
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("top"))
    known = words.join(near, "word", "left")
    is_form = -F.col("top.minus") >= factor * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("top.near")).alias("form"), F.when(is_form, -F.col("top.minus")).alias("form_n"))
    known = stored(known, "known")
    roots = stored(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), "roots")
        roots = moved.select("word", "root")
        if moved.where("on").isEmpty():
            break
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))

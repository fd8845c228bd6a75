"""Operator 13: passages of documents that start in an earlier document too, by prefix-partitioned suffix trees.

The suffixes are those of the words of all texts, cut after `size` words: what is deeper in the tree only repeats
what the suffix of the next word says. A suffix is a word place that has `size` words of its text before it.

1. Prefixes: a pass counts the prefixes of one word, of those that are frequent the prefixes of two words, and so on. The
   shortest prefix of a suffix that is not frequent is the root of its subtree; each subtree has at most the
   suffixes of a part (PART_BYTES of text), but for LEAST_COUNT in a run, and a group is some subtrees (by hash of the root) that fit into memory.
2. Subtrees: every group gets its suffixes, as arrays of (content, document) from each part of the corpus, and puts them in
   order. Suffixes of equal content hang from one internal node of full depth. Its smallest document keeps the passage;
   in the others the words below the node are covered.
3. Prefixes that are frequent at full depth are nodes already. There is no need to gather their suffixes: the smallest
   document of each is one aggregate with partial sums, and the list is sent (see HEAVY).
4. Covered places go back to their texts, whose union of covered words is cut out: chains of nodes, each one
   word on from the last, are the maximal repeats.

Words stand as 64-bit hashes, and so do suffixes, within their group. Null texts have no words and texts of fewer than `size`
words have no suffix. Rows without an id are neither before nor after any other: they lose nothing and nothing is lost
for them. Rows that share an id are one document: a passage that only they have stays in all of them. An empty table gives an
empty result. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays

# Bytes of text whose suffixes make a part of the work (some 1.2 million), and whose covered places come back to one group of texts.
PART_BYTES = 8_000_000
BACK_BYTES = 32_000_000
# Groups that a part has, so that partitions are even, and groups of texts that a shuffle partition has at least.
GROUPS_A_PART = 8
BACK_A_PARTITION = 3
# Suffixes that a task deals out at once.
DEALT = 800_000
# A task counts a prefix from so many places in a run of texts on. A frequent prefix has half a part or more, so at most
# 2 prefixes a part and depth are frequent: this bounds what is sent (8 bytes each).
LEAST_COUNT = 8
HEAVY = 2

_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_ROOT = np.uint64(0x9E3779B97F4A7C15)

# Hash of the first so many words of the suffixes at some places.
Prefix = Callable[[np.ndarray, int], np.ndarray]


def suffixes(ids: pa.Array, texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, Prefix]]:
    """(first text, first word of each text, suffix places, their texts, prefix hashes) of runs of texts; none of rows without an id."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    for first, data, bounds in arrays.chunks(texts):
        hashes, _, _, firsts = arrays.words(data, bounds, fold=False)
        counts = np.where(known[first : first + len(bounds) - 1], np.maximum(np.diff(firsts) - size + 1, 0), 0)
        owner = np.repeat(np.arange(counts.size), counts)
        at = np.arange(owner.size) + np.repeat(firsts[:-1] - (np.cumsum(counts) - counts), counts)
        up, down = arrays.powers(hashes.size + 1)
        sums = np.zeros(hashes.size + 1, np.uint64)
        np.cumsum(hashes * up[: hashes.size], out=sums[1:])

        def prefix(at: np.ndarray, length: int, sums: np.ndarray = sums, down: np.ndarray = down) -> np.ndarray:
            return arrays.mix((sums[at + length] - sums[at]) * down[at])

        yield first, firsts, at, owner, prefix


def found_in(values: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which values are among sorted names."""
    if not names.size or not values.size:
        return np.zeros(values.size, bool)
    return names[np.minimum(np.searchsorted(names, values), names.size - 1)] == values


def count_prefixes(size: int, share: float):
    """mapInArrow function: (depth, prefix, n) of prefixes with `share` of a run's suffixes, as deep as they are that frequent."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, at, _, prefix in suffixes(batch.column(0), batch.column(1), size):
                least = max(LEAST_COUNT, share * at.size)
                for depth in range(1, size + 1):
                    hashes = prefix(at, depth)
                    names, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
                    often = counts >= least
                    if not often.any():
                        break
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(often.sum(), depth, np.int32)), pa.array(names[often].view(np.int64)), pa.array(counts[often])],
                        ["depth", "prefix", "n"],
                    )
                    at = at[often[which]]

    return read


def roots(at: np.ndarray, prefix: Prefix, heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the root, whether it is of full depth) of suffixes: their shortest prefix that is not frequent."""
    root = prefix(at, 1)
    open_ = np.flatnonzero(found_in(root, heavy[0]))
    for depth in range(2, len(heavy) + 1):
        if not open_.size:
            break
        root[open_] = prefix(at[open_], depth)
        open_ = open_[found_in(root[open_], heavy[depth - 1])]
    full = np.zeros(at.size, bool)
    full[open_] = True
    return root, full


def _narrow(numbers: np.ndarray) -> tuple[int, np.ndarray]:
    """(least, the others less it) in as few bytes a number as they need."""
    if not numbers.size:
        return 0, numbers
    base = int(numbers.min())
    span = int(numbers.max()) - base
    kind = np.uint16 if span < 1 << 16 else np.uint32 if span < 1 << 32 else np.uint64
    return base, (numbers - np.int64(base)).astype(kind)


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of numbers as a binary column."""
    data = np.ascontiguousarray(values)
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _dealt(group: np.ndarray, keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """(grp, base, keys, docs): one row a group, with its keys and documents."""
    order = np.argsort(group, kind="stable")
    group = group[order]
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    bounds = np.append(heads, group.size)
    base, docs = _narrow(docs[order])
    return pa.RecordBatch.from_arrays(
        [pa.array(group[heads].astype(np.int64)), pa.array(np.full(heads.size, base)), _binary(keys[order], bounds), _binary(docs, bounds)],
        ["grp", "base", "keys", "docs"],
    )


def _opened(base: int, keys: bytes, docs: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(keys, np.uint64)
    width = len(docs) // names.size
    return names, np.frombuffer(docs, {2: np.uint16, 4: np.uint32, 8: np.uint64}[width]).astype(np.int64) + base


DEALT_ROWS = "grp LONG, base LONG, keys BINARY, docs BINARY"


def deal(size: int, groups: int, heavy):
    """mapInArrow function: the suffixes of texts by group; those whose root is of full depth stay behind."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            for first, _, at, owner, prefix in suffixes(batch.column(0), batch.column(1), size):
                root, full = roots(at, prefix, heavy.value)
                at, owner, root = at[~full], owner[~full], root[~full]
                if not at.size:
                    continue
                held.append((arrays.mix(root * _ROOT) % np.uint64(groups), prefix(at, size), ids[first + owner]))
                n += at.size
                if n >= DEALT:
                    yield _dealt(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, n = [], 0
        if n:
            yield _dealt(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return read


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, documents) of each group of rows in order of groups."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None
    for batch in filter(len, batches):
        for group, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and group != last:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            last = group
            held.append(_opened(*row))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def subtrees(back: int):
    """mapInArrow function over dealt suffixes in order of groups: those that hang from a node with a smaller document, by group of texts."""

    def covered(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        keys, docs = keys[order], docs[order]
        nodes = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        least = np.repeat(np.minimum.reduceat(docs, nodes), np.diff(np.append(nodes, keys.size)))
        return keys[docs > least], docs[docs > least]

    def place(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, docs = (np.concatenate(x) for x in zip(*found, strict=True))
        return _dealt(arrays.mix(docs.view(np.uint64)) % np.uint64(back), keys, docs)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for keys, docs in by_group(batches):
            found.append(covered(keys, docs))
            n += found[-1][0].size
            if n >= DEALT:
                yield place(found)
                found, n = [], 0
        if n:
            yield place(found)

    return read


def _pair(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return arrays.mix(keys + docs.view(np.uint64) * _PAIR)


def least_documents(size: int, heavy):
    """mapInArrow function: (prefix, id) of suffixes whose root is of full depth, with the smallest id of a batch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            for first, _, at, owner, prefix in suffixes(batch.column(0), batch.column(1), size):
                root, full = roots(at, prefix, heavy.value)
                keys, docs = root[full], ids[first + owner[full]]
                if not keys.size:
                    continue
                order = np.argsort(keys)
                keys, docs = keys[order], docs[order]
                heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(keys[heads].view(np.int64)), pa.array(np.minimum.reduceat(docs, heads))], ["prefix", "id"])

    return read


KEPT = "id LONG, n_words LONG, n_removed LONG, kept STRING"


def _without(ids: pa.Array, texts: pa.Array, size: int, covered: np.ndarray, heavy: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """Texts without the words of suffixes that are covered, or hang from a frequent node with a smaller document."""
    raw = [(t.as_py() or "").encode().split() for t in texts]
    n_words = np.fromiter(map(len, raw), np.int64, len(raw))
    removed = np.zeros(len(raw), np.int64)
    if covered.size or heavy[0].size:
        names = ids.fill_null(0).to_numpy()
        for first, firsts, at, owner, prefix in suffixes(ids, texts, size):
            keys, docs = prefix(at, size), names[first + owner]
            out = found_in(_pair(keys, docs), covered)
            if heavy[0].size:
                place = np.minimum(np.searchsorted(heavy[0], keys), heavy[0].size - 1)
                out |= (heavy[0][place] == keys) & (heavy[1][place] < docs)
            edges = np.zeros(int(firsts[-1]) + 1, np.int64)
            np.add.at(edges, at[out], 1)
            np.add.at(edges, at[out] + size, -1)
            stays = np.cumsum(edges)[:-1] == 0
            for k in np.unique(owner[out]).tolist():
                mask = stays[firsts[k] : firsts[k + 1]]
                removed[first + k] = mask.size - np.count_nonzero(mask)
                raw[first + k] = list(itertools.compress(raw[first + k], mask.tolist()))
    kept = pa.array([b" ".join(w).decode() for w in raw], pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(n_words), pa.array(removed), kept], ["id", "n_words", "n_removed", "kept"])


def cut_covered(size: int, heavy):
    """mapInArrow function over rows in order of (grp, text or not): covered places of a group of texts, then the texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, covered = None, [], np.empty(0, np.uint64)
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            number = column["grp"].to_numpy()
            heads = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            for first, last in itertools.pairwise([*heads.tolist(), number.size]):
                if number[first] != group:
                    group, parts, covered = number[first], [], np.empty(0, np.uint64)
                is_text = column["is_text"].slice(first, last - first).to_numpy(zero_copy_only=False)
                texts_at = first + int(np.count_nonzero(~is_text))
                for k in range(first, texts_at):
                    parts.append(_pair(*_opened(*(column[c][k].as_py() for c in ("base", "keys", "docs")))))
                if texts_at < last:
                    if parts:
                        covered, parts = np.unique(np.concatenate([covered, *parts])), []
                    rows = pa.RecordBatch.from_arrays([column[c].slice(texts_at, last - texts_at) for c in ("id", "text")], ["id", "text"])
                    for piece in arrays.pieces(rows, 1):
                        yield _without(piece.column(0), piece.column(1), size, covered, heavy.value)

    return read


def place_texts(back: int):
    """mapInArrow function: rows with the group that covered places come back to; those without an id anywhere."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy().astype(np.int64)
            group = (arrays.mix(ids.view(np.uint64)) % np.uint64(back)).astype(np.int64)
            none = np.flatnonzero(batch.column(0).is_null().to_numpy(zero_copy_only=False))
            group[none] = [zlib.crc32(batch.column(1)[k].as_buffer() or b"") % back for k in none.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], ["grp", "id", "text"])

    return read


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 13) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row: its words joined by one space, without those of passages of `size` words that start in a document with a smaller id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(partitions, -(-n_bytes // PART_BYTES))
    groups = GROUPS_A_PART * parts
    back = max(BACK_A_PARTITION * partitions, -(-n_bytes // BACK_BYTES))

    counted = rows.mapInArrow(count_prefixes(size, 1 / (2 * HEAVY * parts)), "depth INT, prefix LONG, n LONG")
    counted = counted.groupBy("depth", "prefix").agg(F.sum("n").alias("n"))
    # Every suffix has a prefix of one word, but only frequent ones are counted, so a part's share is taken of the bytes: 7 a word.
    often = counted.where(F.col("n") >= max(LEAST_COUNT, n_bytes / 7 / parts / HEAVY)).toPandas()
    heavy = [np.sort(often.loc[often["depth"] == depth, "prefix"].to_numpy(np.int64).view(np.uint64)) for depth in range(1, size + 1)]
    sent = spark.sparkContext.broadcast(heavy)
    nodes = (np.empty(0, np.uint64), np.empty(0, np.int64))
    if heavy[-1].size:
        least = rows.mapInArrow(least_documents(size, sent), "prefix LONG, id LONG").groupBy("prefix").agg(F.min("id").alias("id")).toPandas()
        names = least["prefix"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(names)
        nodes = (names[order], least["id"].to_numpy(np.int64)[order])
    nodes = spark.sparkContext.broadcast(nodes)

    dealt = rows.mapInArrow(deal(size, groups, sent), DEALT_ROWS).repartition("grp").sortWithinPartitions("grp")
    covered = dealt.mapInArrow(subtrees(back), DEALT_ROWS).withColumn("is_text", F.lit(False))
    texts = rows.mapInArrow(place_texts(back), "grp LONG, id LONG, text STRING").withColumn("is_text", F.lit(True))
    both = covered.unionByName(texts, allowMissingColumns=True).repartition("grp").sortWithinPartitions("grp", "is_text")
    return both.mapInArrow(cut_covered(size, nodes), KEPT)

"""Words and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes other than space and \\x09-\\x0d, with A-Z lower-cased. Words and
shingles stand as 64-bit hashes; two different ones meet with a chance of 2**-64 a pair.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 800_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.default_rng(20240).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
# What operators keep in a worker for their next task, by operator, as functions that drop it.
_kept: dict[str, Callable[[], None]] = {}


def keeps(operator: str, drop: Callable[[], None]) -> None:
    """Say that an operator keeps something in its workers."""
    _kept[operator] = drop


def make_room(operator: str) -> None:
    """At the start of a task: drops what other operators keep in this worker and gives free memory back to the system.

    Workers live through the stages of a pipeline, and an executor's limit counts what they hold.
    """
    for other in [name for name in _kept if name != operator]:
        _kept.pop(other)()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(BASE**i, BASE**-i) for i < n; kept for the common size."""
    size = max(CHUNK_BYTES + 1, n)
    if size not in _powers:
        tables = []
        for base in (_BASE, _UNBASE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        if size > CHUNK_BYTES + 1:
            return tables[0], tables[1]
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of all texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) of runs of texts that hold about `size` bytes."""
    data, bounds = flat(texts)
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = max(last, first + 1)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, some megabytes of one column's texts at a time."""
    _, bounds = flat(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + 4 * CHUNK_BYTES, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of True; none crosses a bound."""
    if not inside.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edges = bounds[(bounds > 0) & (bounds < inside.size)]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    stops[:-1] &= ~inside[1:]
    stops[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of `values` (64-bit numbers, one a place)."""
    up, down = powers(values.size + 1)
    sums = np.zeros(values.size + 1, np.uint64)
    np.cumsum(values * up[: values.size], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def byte_values(data: np.ndarray) -> np.ndarray:
    """A random 64-bit number for each byte."""
    return _BYTE[data]


def words(data: np.ndarray, bounds: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word and the number of the first word of each text, with the total last; unfolded words keep their case."""
    starts, ends = runs(~_SPACE[data], bounds)
    hashes = span_hashes(_BYTE[_LOWER[data] if fold else data], starts, ends)
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def word_grams(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bounds) of all n-word shingles by text, in text order; a shorter text has its whole sequence as one."""
    counts = np.diff(firsts)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - firsts[:-1], sizes)
    short = np.repeat(counts < n, sizes)
    out = np.zeros(at.size, np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    ends = np.repeat(firsts[1:], sizes)
    for k in range(n):
        word = padded[at + k]
        if short.any():
            word = np.where(at + k < ends, word, np.uint64(k + 1))
        out = mix(out * _BASE + word)
    return out, bounds


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct shingles as int64) of every text."""
    for first, data, bounds in chunks(texts):
        hashes, _, _, firsts = words(data, bounds)
        grams, ends = word_grams(hashes, firsts, n)
        grams = grams.view(np.int64)
        for k in range(len(bounds) - 1):
            yield first + k, np.unique(grams[ends[k] : ends[k + 1]])


def list_array(lists: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column of numpy arrays."""
    sizes = np.fromiter((x.size for x in lists), np.int32, len(lists))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate(lists) if lists else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))

"""Operator 11: periodic runs of words, by recompression.

A run is a stretch of consecutive words with smallest period q and at least max(least, repeats * q) words that no neighbouring word
extends. The words of many texts stand in one row of symbols, with a symbol of its own before and after each text.

1. Candidates: for every q the places q, 2q, 3q ... of a text (a harmonic grid: n log n places in all). A run of three
   periods has two grid places a period apart, and at least q + 1 equal words from there on, so places whose next two
   words differ are no candidates.
2. Grammar: texts with candidates are compressed by rounds. A round first makes each block of one symbol a symbol, then deals
   all symbols to two sides by hash and makes each pair of a left and a right one a symbol. Equal stretches are
   parsed alike but for their ends, and a text shrinks by a constant factor a round: a run-length grammar.
3. Extensions: the equal words from two places on, in either direction, are counted by climbing to the largest equal
   symbols that start at both, and down where they differ; blocks of one symbol and different lengths agree as long as the
   shorter. No suffix array is built, and a query takes logarithmic time.
4. A candidate with its extensions is a stretch with period q; of one stretch the smallest q is its period.

Symbols are 64-bit hashes of what they stand for, so all texts share them. Null and empty texts have no words and no run. Rows come
out one to one; rows that repeat have the same runs. Extra columns are not read. Words do not meet across rows, so nothing is shuffled;
memory grows with the longest text (some 200 bytes a word of it).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays

# Symbols that texts are compressed with at once, and queries that are answered at once.
SYMBOLS = 400_000
QUERIES = 200_000

_SALTS = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIDE = np.uint64(0xD6E8FEB86659FD93)
_EDGE = np.uint64(0x632BE59BD9B4E019)


class Grammar:
    """The symbols of all rounds over a row of symbols, the last round's first; of each its parent, children and length.

    `fixed` symbols are never compressed; they must differ from each other and from all others.
    """

    def __init__(self, symbols: np.ndarray, fixed: np.ndarray):
        n = symbols.size
        size, base, count = np.ones(n, np.int64), symbols, np.ones(n, np.int64)
        rounds: list[dict[str, np.ndarray]] = [{"symbol": symbols, "size": size, "base": base, "count": count, "child": np.full(n, -1)}]
        heads: list[np.ndarray] = []
        grown = 0
        while grown < 2 and len(rounds) < 250:
            symbol, fix = rounds[-1]["symbol"], fixed
            if len(rounds) % 2:  # blocks
                new = np.append(True, (symbol[1:] != symbol[:-1]) | fix[1:] | fix[:-1])
            else:  # pairs
                side = (arrays.mix(symbol * _SALTS[len(rounds)]) >> np.uint64(63)).astype(bool)
                second = np.zeros(symbol.size, bool)
                second[1:] = ~side[:-1] & side[1:] & ~fix[:-1] & ~fix[1:]
                new = ~second
            head = np.flatnonzero(new)
            grown = grown + 1 if head.size == symbol.size else 0
            count = np.diff(np.append(head, symbol.size))
            base = symbol[head]
            if len(rounds) % 2:
                made = np.where(count > 1, arrays.mix(base + arrays.mix(count.astype(np.uint64) * _SIDE)), base)
            else:
                last = symbol[head + count - 1]
                made = np.where(count > 1, arrays.mix(arrays.mix(base) * _SALTS[0] + last), base)
                base = made
            ends = np.append(0, np.cumsum(rounds[-1]["size"]))
            edges = np.append(head, symbol.size)
            heads.append(head)
            rounds.append({"symbol": made, "size": ends[edges[1:]] - ends[edges[:-1]], "base": base, "count": count if len(rounds) % 2 else np.ones(head.size, np.int64), "child": head})
            fixed = fix[head]
        first = np.cumsum([0] + [r["symbol"].size for r in rounds])
        self.symbol, self.size, self.base, self.count = (np.concatenate([r[k] for r in rounds]) for k in ("symbol", "size", "base", "count"))
        total = int(first[-1])
        self.child = np.full(total, -1)
        self.last = np.full(total, -1)
        self.parent = np.full(total, -1)
        self.is_first = np.zeros(total, bool)
        self.is_last = np.zeros(total, bool)
        for k, head in enumerate(heads):
            below, above, n = int(first[k]), int(first[k + 1]), rounds[k]["symbol"].size
            ends = np.append(head[1:], n) - 1
            self.child[above : above + head.size] = below + head
            self.last[above : above + head.size] = below + ends
            self.parent[below : below + n] = above + np.repeat(np.arange(head.size), ends - head + 1)
            self.is_first[below + head] = True
            self.is_last[below + ends] = True

    def extension(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols of the row are equal from places x and y on, forward (step 1) or backward (-1)."""
        out = np.zeros(x.size, np.int64)
        for begin in range(0, x.size, QUERIES):
            out[begin : begin + QUERIES] = self._extension(x[begin : begin + QUERIES], y[begin : begin + QUERIES], step)
        return out

    def _extension(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        at_edge, down = (self.is_first, self.child) if step > 0 else (self.is_last, self.last)
        out = np.zeros(x.size, np.int64)
        live = np.arange(x.size)
        x, y = x.astype(np.int64), y.astype(np.int64)
        while live.size:
            px, py = self.parent[x], self.parent[y]
            up = at_edge[x] & at_edge[y] & (px >= 0)
            up[up] = self.symbol[px[up]] == self.symbol[py[up]]
            same = ~up & (self.symbol[x] == self.symbol[y])
            differ = ~up & ~same
            dx, dy = down[x], down[y]
            end = differ & (dx < 0)
            into = differ & ~end
            # Blocks of one symbol agree as long as the shorter; otherwise their first children are compared.
            block = into & (self.base[x] == self.base[y])
            skip = np.where(block, np.minimum(self.count[x], self.count[y]), 0)
            out[live[same]] += self.size[x[same]]
            out[live[block]] += skip[block] * self.size[dx[block]]
            x = np.where(up, px, np.where(same, x + step, np.where(into, dx + step * skip, x)))
            y = np.where(up, py, np.where(same, y + step, np.where(into, dy + step * skip, y)))
            if end.any():
                live, x, y = live[~end], x[~end], y[~end]
        return out


def candidates(row: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, q): grid places of one text whose next two words are those q places on. `row` has a symbol for each two neighbours."""
    n = row.size
    if n < least:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    periods = np.arange(1, n // repeats + 1)
    many = (n - 1) // periods
    total = np.cumsum(many)
    places, found = [], []
    first = 0
    while first < periods.size:
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + QUERIES, "right")))
        here = many[first:last]
        q = np.repeat(periods[first:last], here)
        place = (np.arange(q.size) - np.repeat(np.cumsum(here) - here, here)) * q
        hit = np.flatnonzero(row[place] == row[place + q])
        places.append(place[hit])
        found.append(q[hit])
        first = last
    return np.concatenate(places), np.concatenate(found)


def solve(texts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], least: int, repeats: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, starts, ends, periods) of the runs of texts (key, symbols, candidate places, their periods), by start, then period."""
    count = np.array([t[1].size for t in texts])
    first = np.cumsum(count + 1) - count
    symbols = np.zeros(int(count.sum()) + count.size + 1, np.uint64)
    fixed = np.ones(symbols.size, bool)
    for begin, text in zip(first.tolist(), texts, strict=True):
        symbols[begin : begin + text[1].size] = text[1]
        fixed[begin : begin + text[1].size] = False
    symbols[fixed] = arrays.mix(np.arange(1, fixed.sum() + 1, dtype=np.uint64) * _EDGE)
    grammar = Grammar(symbols, fixed)
    key = np.repeat(np.arange(count.size), [t[2].size for t in texts])
    place = np.concatenate([t[2] for t in texts]) + first[key]
    q = np.concatenate([t[3] for t in texts])
    # Of grid places in a row the first is asked; others in its stretch have the same, and what lies beyond is asked next.
    head = np.ones(key.size, bool)
    head[1:] = (key[1:] != key[:-1]) | (q[1:] != q[:-1]) | (place[1:] != place[:-1] + q[1:])
    ahead = grammar.extension(place[head], place[head] + q[head], 1)
    rest = ~head & (place >= (place[head] + ahead)[np.cumsum(head) - 1])
    asked = np.append(np.flatnonzero(head), np.flatnonzero(rest))
    ahead = np.append(ahead, grammar.extension(place[rest], place[rest] + q[rest], 1))
    # The first grid place of a run has more than a period of equal words before it.
    asked, ahead = asked[ahead > q[asked]], ahead[ahead > q[asked]]
    key, place, q = key[asked], place[asked], q[asked]
    behind = grammar.extension(place - 1, place + q - 1, -1)
    start, end = place - behind, place + q + ahead
    long = end - start >= np.maximum(least, repeats * q)
    key, start, end, q = (x[long] for x in (key, start, end, q))
    order = np.lexsort((q, end, start, key))
    key, start, end, q = (x[order] for x in (key, start, end, q))
    new = np.ones(key.size, bool)
    new[1:] = (np.diff(key) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)
    key, start, end, q = (x[new] for x in (key, start, end, q))
    order = np.lexsort((q, start, key))
    key, start, end, q = (x[order] for x in (key, start, end, q))
    bounds = np.searchsorted(key, np.arange(count.size + 1))
    for k, text in enumerate(texts):
        own = slice(bounds[k], bounds[k + 1])
        yield text[0], start[own] - first[k], end[own] - first[k], q[own]


def text_runs(texts: pa.Array, least: int, repeats: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, ends, periods) by the number of the text, for texts that have a run."""
    out = {}
    held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def answer() -> None:
        out.update((k, found) for k, *found in solve(held, least, repeats) if found[0].size)

    for first, data, bounds in arrays.chunks(texts):
        hashes, _, _, firsts = arrays.words(data, bounds, fold=False)
        two = arrays.mix(hashes) * _SALTS[1]
        two[:-1] += hashes[1:]
        for k in range(len(bounds) - 1):
            begin, end = int(firsts[k]), int(firsts[k + 1])
            row = two[begin:end]
            if row.size:
                # The last word has no neighbour.
                row[-1] = _EDGE
            place, q = candidates(row, least, repeats)
            if place.size:
                held.append((first + k, hashes[begin:end].copy(), place, q))
                size += end - begin + place.size
                if size >= SYMBOLS:
                    answer()
                    held, size = [], 0
    if held:
        answer()
    return out


RUNS = "id LONG, n_words LONG, runs ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>, collapsed STRING"


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 24, repeats: int = 3) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: its runs by start, then period, and its words without what follows the first period of any run.

    `repeats` is 3 at least: with fewer a grid place need not have two equal words.
    """
    if repeats < 3:
        raise ValueError("repeats must be 3 or more")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.pieces(batch, 1):
                found = text_runs(piece.column(1), least, repeats)
                words = [(t.as_py() or "").encode().split() for t in piece.column(1)]
                sizes = pa.array([len(w) for w in words], pa.int64())
                for k, (start, end, q) in found.items():
                    edges = np.zeros(len(words[k]) + 1, np.int64)
                    np.add.at(edges, start + q, 1)
                    np.add.at(edges, end, -1)
                    words[k] = list(itertools.compress(words[k], (np.cumsum(edges)[:-1] == 0).tolist()))
                empty = np.empty(0, np.int64)
                lists = [found.get(k, (empty, empty, empty)) for k in range(piece.num_rows)]
                offsets = pa.array(np.append(0, np.cumsum([x[0].size for x in lists])).astype(np.int32))
                start, end, q = (np.concatenate([x[c] for x in lists]) for c in range(3))
                runs = pa.StructArray.from_arrays([pa.array(start), pa.array(end - start), pa.array(q)], ["start", "length", "period"])
                collapsed = pa.array([b" ".join(w).decode() for w in words], pa.string())
                yield pa.RecordBatch.from_arrays([piece.column(0), sizes, pa.ListArray.from_arrays(offsets, runs), collapsed], ["id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(read, RUNS)


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest length by period; of equal ones the first, and the shorter period. Null if there is none."""
    kind = "STRUCT<start: LONG, length: LONG, period: LONG>"

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run.length * best.period > best.length * run.period), run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast(kind), better)

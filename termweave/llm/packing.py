"""Operator 5: packing of documents into token sequences by swap-based local search.

Documents become token ids with an end id; one longer than a sequence is cut so that only its
first piece is shorter than a sequence. Full pieces fill a sequence each. The others are dealt
at random into blocks of bounded size. In a block, best fit in falling order gives a first
packing, then a local search improves it: the emptiest bins give one document for one, two for
one or one for two, or move one, to a fuller bin, always so that the sum of squared fills grows,
until they are empty or nothing helps. Bins that stay clearly underfull are dealt anew with those
of the other blocks, so that a large input wastes no more than a small one.

A null text counts as empty and gives its end id alone. Rows that repeat are packed as often as they
occur. Equal lengths are taken in the order of their keys. Of extra columns none is read. An empty
table gives no row. Memory: one text's ids, one block of pieces, and a cache of words of bounded size.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays
from termweave.llm.store import stored

# Pieces in a block: 20,000 leave less than one bin in ten thousand to gain from a larger block.
BLOCK = 20_000
# Bins filled less than this share are dealt anew.
LOW_FILL = 0.985
# Words whose ids a task keeps.
CACHED_WORDS = 400_000

# Byte classes of plain text: letters (also two-byte Latin ones), digits, white space, all else; 9 needs the slow way.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[:0x80] = 3
for _low, _high in (("a", "z"), ("A", "Z")):
    _CLASS[ord(_low) : ord(_high) + 1] = 0
_CLASS[ord("0") : ord("9") + 1] = 1
_CLASS[[0x20, *range(0x09, 0x0E)]] = 2
_CLASS[0xC3:0xC9] = 0
_CLASS[0x80:0xC0] = 0
# What the fast way leaves to the tokenizer: signs among the two-byte letters, contractions, and other lead bytes.
_ODD = re.compile(rb"[\xc0-\xc2\xc9-\xff]|\xc3[\x97\xb7]|'[a-z]")


def word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the words of byte-level BPE in texts without odd bytes.

    Words are runs of letters, digits, other signs or white space; a single space before a
    run belongs to it, and the last of several white space characters stands apart.
    """
    kind = _CLASS[data]
    starts = np.zeros(data.size, bool)
    starts[bounds[:-1][bounds[:-1] < data.size]] = True
    starts[1:] |= kind[1:] != kind[:-1]
    first = np.flatnonzero(starts)
    last = np.append(first[1:], data.size) - 1
    at_end = np.zeros(data.size + 1, bool)
    at_end[bounds] = True
    blank = (kind[first] == 2) & ~at_end[last + 1]
    lone = blank & (data[last] == 0x20)
    # The space before a run becomes its start; white space of one space only is no word of its own.
    starts[last[lone] + 1] = False
    starts[last[blank]] = True
    return np.flatnonzero(starts)


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def load_merges(path: str):
    """The merges of a byte-level BPE file as a function from a word to its ids, or None if ranks do not follow ids.

    A single word needs no cutting, so the plain merge loop of tiktoken gives the same ids as the tokenizer, in a fifth of the time.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, added = spec["model"], {token["content"] for token in spec.get("added_tokens", [])}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    made = [model["vocab"][a + b] for a, b in merges]
    if model.get("type", "BPE") != "BPE" or made != sorted(made):
        return None
    # Byte-level BPE writes a printable byte as itself and the others, in order, as the characters from 256 on.
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
    ranks = {bytes(byte_of[c] for c in token): k for token, k in model["vocab"].items() if token not in added}
    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=4)
def load_added(path: str) -> re.Pattern[bytes] | None:
    """What texts with an added token hold: the tokenizer cuts these out before words."""
    added = [token.content.encode() for token in load_tokenizer(path).get_added_tokens_decoder().values()]
    # Any case, as a token that the file normalises is found in other forms too.
    return re.compile(b"|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)), re.IGNORECASE) if added else None


def forget() -> None:
    """Drop the vocabularies that this worker holds: they are large, and other operators do not need them."""
    for cached in (load_tokenizer, load_merges, load_added):
        cached.cache_clear()


class Encoder:
    """Ids of whole texts; words that repeat are looked up."""

    def __init__(self, path: str):
        self.tokenizer, self.added = load_tokenizer(path), load_added(path)
        self.merge = load_merges(path) or (lambda word: self.tokenizer.encode(word, add_special_tokens=False).ids)
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.bounds = [0]

    def learn(self, hashes: list[int], words: list[str]) -> None:
        flat: list[int] = []
        first, end = len(self.bounds) - 1, self.bounds[-1]
        for word in words:
            flat += self.merge(word)
            self.bounds.append(end + len(flat))
        self.known.update(zip(hashes, range(first, first + len(hashes)), strict=True))
        if self.bounds[-1] > self.ids.size:
            self.ids = np.concatenate([self.ids, np.empty(max(self.ids.size, len(flat)), np.uint32)])
        self.ids[end : self.bounds[-1]] = flat

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        for _, data, bounds in arrays.chunks(texts):
            raw = data.tobytes()
            n = len(bounds) - 1
            if not raw:
                yield from (np.empty(0, np.uint32) for _ in range(n))
                continue
            odd = np.zeros(n, bool)
            at = [m.start() for m in _ODD.finditer(raw)]
            # A match across the end of a text could hide one in the next: both are odd, which costs time only.
            at += [k for m in self.added.finditer(raw) for k in (m.start(), m.end() - 1)] if self.added else []
            if at:
                odd[np.unique(np.searchsorted(bounds, at, "right") - 1)] = True
            slow = iter(())
            if odd.any():
                whole = [raw[bounds[k] : bounds[k + 1]].decode() for k in np.flatnonzero(odd)]
                slow = (np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch(whole, add_special_tokens=False))
            if odd.all():
                yield from slow
                continue
            if len(self.known) > CACHED_WORDS:
                self.clear()
            starts = word_starts(data, bounds)
            ends = np.append(starts[1:], data.size)
            firsts = np.searchsorted(starts, bounds)
            if odd.any():
                plain = ~np.repeat(odd, np.diff(firsts))
                starts, ends = starts[plain], ends[plain]
                firsts = np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(firsts)))])
            hashes, where, number = np.unique(
                arrays.span_hashes(arrays.byte_values(data), starts, ends), return_index=True, return_inverse=True
            )
            keys = hashes.tolist()
            new = [k for k, key in enumerate(keys) if key not in self.known]
            if new:
                spans = where[new]
                words = [raw[a:b].decode() for a, b in zip(starts[spans].tolist(), ends[spans].tolist(), strict=True)]
                self.learn([keys[k] for k in new], words)
            slot = np.fromiter((self.known[key] for key in keys), np.int64, len(keys))
            limits = np.array(self.bounds, np.int64)
            begin, size = limits[slot][number], np.diff(limits)[slot][number]
            stops = np.concatenate([[0], np.cumsum(size)])
            ids = self.ids[np.arange(stops[-1]) + np.repeat(begin - stops[:-1], size)]
            for k in range(n):
                yield next(slow) if odd[k] else ids[stops[firsts[k]] : stops[firsts[k + 1]]]


def token_pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = 1024, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), and with_ids also ids, of every piece."""
    fields = f"{key} LONG, piece INT, start LONG, length LONG, ids_crc32 LONG" + ", ids ARRAY<INT>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("packing")
        arrays.keeps("packing", forget)
        encoder = Encoder(tokenizer)
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows: list[tuple] = []
            pieces: list[np.ndarray] = []
            for name, found in zip(names, encoder.encode(batch.column(1)), strict=True):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                n = -(-ids.size // size)
                head = ids.size - size * (n - 1)
                for k in range(n):
                    begin = 0 if k == 0 else head + size * (k - 1)
                    part = ids[begin : head + size * k]
                    rows.append((name, k, begin, part.size, zlib.crc32(part.tobytes())))
                    if with_ids:
                        pieces.append(part.astype(np.int32))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            if with_ids:
                columns.append(arrays.list_array(pieces, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(cut, fields)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers: best fit in falling order of length."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = size, len(bins)
            bins.append([])
        bins[at].append(item)
        if left := room - length:
            by_room[left].append(at)
            rooms |= 1 << left
    return bins


class Search:
    """Local search over the bins of a block: exchanges that raise the sum of squared fills."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], size: int):
        self.lengths, self.bins, self.size = lengths, bins, size
        self.fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)

    def offers(self, items: list[int]) -> tuple[np.ndarray, list[tuple[int, ...]]]:
        """Lengths of nothing, single documents and pairs of a bin."""
        groups: list[tuple[int, ...]] = [()] + [(i,) for i in items]
        groups += [(i, j) for k, i in enumerate(items) for j in items[k + 1 :]]
        return np.array([int(self.lengths[list(g)].sum()) if g else 0 for g in groups], np.int64), groups

    def run(self, low: float) -> None:
        """Empty the bins filled less than `low` of a sequence, emptiest first, as far as exchanges go."""
        open_ = np.flatnonzero(self.fill < self.size)
        sums: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        groups: dict[int, list[tuple[int, ...]]] = {}

        def lay(b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            values, groups[b] = self.offers(self.bins[b])
            return values, np.full(values.size, b), np.array([len(g) for g in groups[b]])

        for b in open_.tolist():
            values, own, n = lay(b)
            sums.append(values)
            owner.append(own)
            counts.append(n)
        if not sums:
            return
        table, own, n = np.concatenate(sums), np.concatenate(owner), np.concatenate(counts)
        place = np.concatenate([np.arange(x.size) for x in sums])
        donors = [b for b in open_[np.argsort(self.fill[open_], kind="stable")].tolist() if self.fill[b] < low * self.size]
        for donor in donors:
            while self.bins[donor]:
                a = self.fill[donor]
                best = (0, -1, ())
                for group in self.offers(self.bins[donor])[1][1:]:
                    gives = int(self.lengths[list(group)].sum())
                    gain = gives - table
                    others = (own != donor) & (gain > 0) & (gain <= self.size - self.fill[own]) & (n + len(group) <= 3)
                    value = np.where(others, gain * (self.fill[own] - a + gain), 0)
                    at = int(value.argmax())
                    if value[at] > best[0]:
                        best = (int(value[at]), at, group)
                if best[1] < 0:
                    break
                _, at, group = best
                other = int(own[at])
                back = groups[other][place[at]]
                self.bins[donor] = [i for i in self.bins[donor] if i not in group] + list(back)
                self.bins[other] = [i for i in self.bins[other] if i not in back] + list(group)
                stay = (own != donor) & (own != other)
                table, own, n, place = table[stay], own[stay], n[stay], place[stay]
                for b in (donor, other):
                    self.fill[b] = int(self.lengths[self.bins[b]].sum())
                    if 0 < self.fill[b] < self.size:
                        values, of, k = lay(b)
                        table, own, n = np.append(table, values), np.append(own, of), np.append(n, k)
                        place = np.append(place, np.arange(values.size))


def pack_block(lengths: np.ndarray, size: int, low: float = LOW_FILL) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill of the bin) of each item."""
    search = Search(lengths, best_fit(lengths, size), size)
    search.run(low)
    bins, offsets, fills = (np.zeros(lengths.size, np.int64) for _ in range(3))
    number = 0
    for items in search.bins:
        if items:
            items = sorted(items)
            ends = np.cumsum(lengths[items])
            bins[items], offsets[items], fills[items] = number, ends - lengths[items], ends[-1]
            number += 1
    return bins, offsets, fills


def pack(pieces: DataFrame, size: int = 1024, block: int = BLOCK, low: float = LOW_FILL, rounds: int = 4) -> DataFrame:
    """pieces(length, ...) with (sequence_id, offset): sequences of at most `size` tokens, gapless from 0."""
    names = pieces.columns
    full = pieces.where(F.col("length") >= size).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    left = pieces.where(F.col("length") < size)
    done = [full]
    schema = left.limit(0).select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("fill")).schema
    for turn in range(rounds):
        total = left.count()
        n_blocks = max(1, -(-total // block))

        def place(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values([c for c in names if c != "ids"], kind="stable").reset_index(drop=True)
            bins, offsets, fills = pack_block(group["length"].to_numpy(np.int64), size, low)
            number = int(group["block"].iloc[0]) << 24
            return group.drop(columns="block").assign(sequence_id=bins + number, offset=offsets, fill=fills)

        keys = [F.col(c) for c in names if c != "ids"]
        dealt = left.withColumn("block", F.pmod(F.xxhash64(F.lit(turn), *keys), F.lit(n_blocks)).cast("int"))
        packed = stored(dealt.groupBy("block").applyInPandas(place, schema), "packed")
        packed = packed.withColumn("sequence_id", F.col("sequence_id") + (turn << 58))
        last = n_blocks == 1 or turn == rounds - 1
        ready = packed if last else packed.where(F.col("fill") >= low * size)
        done.append(ready.drop("fill"))
        if last:
            break
        left = packed.where(F.col("fill") < low * size).select(*names)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = 1024, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """Every piece of every document with its sequence and its place there; with_ids adds the ids themselves."""
    pieces = stored(token_pieces(docs, tokenizer, key, text, size, end_id, with_ids), "pieces")
    return pack(pieces, size)

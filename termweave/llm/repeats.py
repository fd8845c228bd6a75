"""Operator 6: removal of repeated byte strings by prefix-free parsing.

Every `size`-byte string (window) of a text that also starts at another place of the corpus goes, the
bytes it covers included. A rolling hash of GRAM bytes makes triggers: in each window the
smallest hash is one, so equal windows have the same trigger at the same place, and no window is
without one. The windows that share a trigger form a phrase: the bytes they cover, which starts and ends by
content alone, so that equal phrases are parsed alike wherever they stand.

1. Parse: one row a phrase, with hashes of the whole phrase and of the bytes before and after its trigger.
2. Dictionary: phrases that are equal are one entry with a count. All windows of an entry that occurs
   twice are repeats, and need no sorting.
3. Corpus order: two windows of different entries can be equal only if the entries agree on the half before or
   after the trigger. Only such entries, once each, bring their bytes; within each half the windows are
   sorted by the place of the trigger and by content, and equal neighbours are repeats. Suffixes that
   share no half with another entry never enter a sort, which is what keeps the order small.
4. Repeats of an entry hold for its occurrence; the spans of a text are merged and cut out.

Rows come out one to one. Null texts count as empty; texts shorter than a window lose nothing.
Rows that repeat, with the same id or another, are places of their own, so their long texts
repeat each other. Rows with equal id and text share their spans. Extra columns are not read. A long text is
parsed in segments of windows, so memory does not grow with it beyond the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays
from termweave.llm.store import by_ids, stored

GRAM = 16
# Entries that share a half: beyond the first number, and the second, their windows are dealt to more groups.
SPREAD = ((4_000, 25), (100_000, 1))


def segments(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, place of the bytes in it, bytes, bounds): runs of whole texts, or parts of one that overlap by size - 1 bytes."""
    for first, data, bounds in arrays.chunks(texts):
        if len(bounds) > 2 or data.size <= 2 * arrays.CHUNK_BYTES:
            yield first, 0, data, bounds
            continue
        for begin in range(0, max(1, data.size - size + 1), arrays.CHUNK_BYTES):
            part = data[begin : begin + arrays.CHUNK_BYTES + size - 1]
            yield first, begin, part, np.array([0, part.size])


def phrases(data: np.ndarray, bounds: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """The phrases of texts: text, place of the trigger, windows as distances from their start to it, and hashes."""
    n, width = data.size, size - GRAM + 1
    lengths = np.diff(bounds)
    counts = np.maximum(lengths - size + 1, 0)
    if not counts.sum():
        return {}
    up, down = arrays.powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(arrays.byte_values(data) * up[:n], out=sums[1:])

    def spans(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return arrays.mix((sums[b] - sums[a]) * down[a])

    m = n - GRAM + 1
    rolled = (sums[GRAM:] - sums[:m]) * down[:m] * np.uint64(0xD6E8FEB86659FD93)
    low = np.uint64(0xFFFFFFFF)
    # Of equal hashes the last is the trigger: the place, counted back, in the low half.
    padded = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = (rolled & ~low) | (low - np.arange(m, dtype=np.uint64))
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    text = np.repeat(np.arange(counts.size), counts)
    start = np.arange(text.size) + np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts)
    trigger = (low - (np.minimum(behind[start], ahead[start + width - 1]) & low)).astype(np.int64)
    new = np.ones(start.size, bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], start.size) - 1
    at = trigger[heads]
    far, near = at - start[heads], at - start[ends]
    half = size // 2
    has_left, has_right = far >= half, near < half
    left, right = np.zeros(at.size, np.uint64), np.zeros(at.size, np.uint64)
    left[has_left] = spans(at[has_left] - half, at[has_left])
    right[has_right] = spans(at[has_right], at[has_right] + size - half + 1)
    return {
        "text": text[heads],
        "place": at - bounds[text[heads]],
        "near": near,
        "far": far,
        "whole": spans(at - far, at - near + size).view(np.int64),
        "left": left.view(np.int64),
        "right": right.view(np.int64),
        "has_left": has_left,
        "has_right": has_right,
    }


def parse(rows: DataFrame, size: int) -> DataFrame:
    """One row a phrase of rows(id, tag, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column(0), batch.column(1)
            for first, begin, data, bounds in segments(batch.column(2), size):
                found = phrases(data, bounds, size)
                if not found:
                    continue
                at = pa.array(found["text"] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(at),
                        tags.take(at),
                        pa.array(found["place"] + begin),
                        pa.array(found["near"].astype(np.int32)),
                        pa.array(found["far"].astype(np.int32)),
                        pa.array(found["whole"]),
                        pa.array(found["left"], mask=~found["has_left"]),
                        pa.array(found["right"], mask=~found["has_right"]),
                    ],
                    ["id", "tag", "place", "near", "far", "whole", "left", "right"],
                )

    return rows.mapInArrow(read, "id LONG, tag LONG, place LONG, near INT, far INT, whole LONG, left LONG, right LONG")


def _contents(size: int):
    """mapInArrow function: (side, half, slot, id, tag, place, near, far, single, bytes) for the asked windows of texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, asked = batch.column(2), batch.column(3)
            for k in range(batch.num_rows):
                raw = texts[k].as_py().encode()
                want = asked[k].values
                place, near, far = (want.field(c).to_numpy() for c in ("place", "near", "far"))
                parts = [raw[p - f : p - n + size] for p, n, f in zip(place.tolist(), near.tolist(), far.tolist(), strict=True)]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(want.field(c) for c in ("side", "half", "slot")),
                        pa.array([batch.column(0)[k].as_py()] * n, pa.int64()),
                        pa.array([batch.column(1)[k].as_py()] * n, pa.int64()),
                        *(want.field(c) for c in ("place", "near", "far", "single")),
                        pa.array(parts, pa.binary()),
                    ],
                    ["side", "half", "slot", "id", "tag", "place", "near", "far", "single", "bytes"],
                )

    return read


def _equal_windows(size: int):
    """mapInArrow function over contents sorted by (side, half, slot): spans of windows that another entry of the group has too."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def key(batch: pa.RecordBatch, k: int) -> tuple:
            return tuple(batch.column(c)[k].as_py() for c in range(3))

        def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            columns = {c: table.column(c) for c in table.column_names}
            side, half, slot, place, near, far = (columns[c].to_numpy() for c in ("side", "half", "slot", "place", "near", "far"))
            group = np.zeros(side.size, np.int64)
            group[1:] = np.cumsum((np.diff(side) != 0) | (np.diff(half) != 0) | (np.diff(slot) != 0))
            data = np.frombuffer(b"".join(columns["bytes"].to_pylist()), np.uint8)
            counts = (far - near + 1).astype(np.int64)
            begins = np.cumsum(counts + size - 1) - (counts + size - 1)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            # Whole groups, about a million windows at a time.
            edges = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            edges = np.append(edges, group.size)
            first = 0
            while first < edges.size - 1:
                last = first + 1
                total = np.cumsum(counts[edges[first] :])
                while last < edges.size - 1 and total[edges[last + 1] - 1 - edges[first]] < 1_000_000:
                    last += 1
                a, b = edges[first], edges[last]
                lo, hi = begins[a], begins[b - 1] + counts[b - 1] + size - 1
                here = data[lo:hi]
                up, down = arrays.powers(here.size + 1)
                sums = np.zeros(here.size + 1, np.uint64)
                np.cumsum(arrays.byte_values(here) * up[: here.size], out=sums[1:])
                member = np.repeat(np.arange(a, b), counts[a:b])
                step = np.arange(member.size) - np.repeat(np.cumsum(counts[a:b]) - counts[a:b], counts[a:b])
                at = begins[member] - lo + step
                content = arrays.mix((sums[at + size] - sums[at]) * down[at])
                distance = (far[member] - step).astype(np.uint64)
                content = arrays.mix(content + distance * np.uint64(0x9E3779B97F4A7C15) + group[member].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
                order = np.argsort(content, kind="stable")
                same = content[order][1:] == content[order][:-1]
                repeat = np.zeros(member.size, bool)
                repeat[order[1:][same]] = True
                repeat[order[:-1][same]] = True
                heads, stops = arrays.runs(repeat, np.append(np.cumsum(counts[a:b]) - counts[a:b], member.size))
                of = member[heads]
                start = place[of] - far[of] + step[heads]
                out.append((of, start, start + (stops - heads) - 1 + size))
                first = last
            of = np.concatenate([x[0] for x in out])
            keep = columns["single"].to_numpy()[of]
            of = pa.array(of[keep])
            return pa.RecordBatch.from_arrays(
                [
                    columns["id"].combine_chunks().take(of),
                    columns["tag"].combine_chunks().take(of),
                    pa.array(np.concatenate([x[1] for x in out])[keep]),
                    pa.array(np.concatenate([x[2] for x in out])[keep]),
                ],
                ["id", "tag", "start", "end"],
            )

        for batch in filter(len, batches):
            # The last group may go on in the next batch.
            last = key(batch, batch.num_rows - 1)
            cut = batch.num_rows
            while cut and key(batch, cut - 1) == last:
                cut -= 1
            if cut:
                yield solve([*held, batch.slice(0, cut)])
                held = []
            elif held and key(held[-1], 0) != last:
                yield solve(held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield solve(held)

    return spans


def repeated_spans(rows: DataFrame, size: int) -> DataFrame:
    """(id, tag, start, end) of bytes of rows(id, tag, text) that repeated windows cover; spans may overlap."""
    parsed = stored(parse(rows.where(F.octet_length("text") >= size), size), "parsed")
    entry = ["whole", "left", "right", "near", "far"]
    first = F.min(F.struct("id", "tag", "place")).alias("first")
    book = stored(parsed.groupBy(*entry).agg(F.count(F.lit(1)).alias("n"), first), "dictionary")

    twice = book.where("n > 1").select(*(F.col(c).alias(f"_{c}") for c in entry))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("left", "right")] + [F.col(c) == F.col(f"_{c}") for c in ("whole", "near", "far")]
    known = parsed.join(twice, same, "left_semi").select(
        "id", "tag", (F.col("place") - F.col("far")).alias("start"), (F.col("place") - F.col("near") + size).alias("end")
    )

    half = size // 2
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("left").alias("half"), F.greatest("near", F.lit(half)).alias("near"), F.col("far").alias("far")),
        F.struct(F.lit(1).alias("side"), F.col("right").alias("half"), F.col("near").alias("near"), F.least("far", F.lit(half - 1)).alias("far")),
    )
    halves = book.select("n", "first.*", F.explode(sides).alias("s")).select("n", "id", "tag", "place", "s.*").where(F.col("half").isNotNull())
    open_ = halves.groupBy("side", "half").agg(F.count(F.lit(1)).alias("entries"), F.min("n").alias("fewest")).where("entries > 1 AND fewest = 1")
    step = F.when(F.col("entries") <= SPREAD[0][0], size)
    for (_, wide), (most, _) in zip(SPREAD, SPREAD[1:], strict=False):
        step = step.when(F.col("entries") <= most, wide)
    step = step.otherwise(SPREAD[-1][1])
    asked = halves.join(open_.select("side", "half", step.alias("step")), ["side", "half"])
    slots = F.explode(F.sequence((F.col("near") / F.col("step")).cast("int"), (F.col("far") / F.col("step")).cast("int"))).alias("slot")
    asked = asked.select("*", slots).select(
        "id",
        "tag",
        F.struct(
            "side",
            "half",
            "slot",
            "place",
            F.greatest("near", F.col("slot") * F.col("step")).alias("near"),
            F.least("far", (F.col("slot") + 1) * F.col("step") - 1).alias("far"),
            (F.col("n") == 1).alias("single"),
        ).alias("w"),
    )
    asked = stored(asked.groupBy("id", "tag").agg(F.collect_list("w").alias("asked")), "asked")
    named = asked.select(F.col("id").alias("_i"), F.col("tag").alias("_t"), "asked")
    texts = by_ids(rows, "id", asked.select("id"), "left_semi").dropDuplicates(["id", "tag"])
    texts = texts.join(named, F.col("id").eqNullSafe(F.col("_i")) & (F.col("tag") == F.col("_t"))).select("id", "tag", "text", "asked")
    kind = "side INT, half LONG, slot INT, id LONG, tag LONG, place LONG, near INT, far INT, single BOOLEAN, bytes BINARY"
    contents = texts.mapInArrow(_contents(size), kind).repartition("side", "half", "slot").sortWithinPartitions("side", "half", "slot")
    found = contents.mapInArrow(_equal_windows(size), "id LONG, tag LONG, start LONG, end LONG")
    return known.unionByName(found)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 400) -> DataFrame:
    """(id, kept BINARY, n_bytes, n_removed, n_spans) of every row: the bytes left when repeated windows are cut out."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("tag"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(rows, size)
    lists = stored(spans.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    touched = by_ids(rows, "id", lists.select("id"), "left_semi")
    named = lists.select(F.col("id").alias("_i"), F.col("tag").alias("_t"), "spans")
    touched = touched.join(named, F.col("id").eqNullSafe(F.col("_i")) & (F.col("tag") == F.col("_t")), "left").select("id", "text", "spans")
    none = F.lit(None).cast("ARRAY<STRUCT<start: LONG, end: LONG>>")
    others = by_ids(rows, "id", lists.select("id"), "left_anti").select("id", "text", none.alias("spans"))
    return touched.unionByName(others).mapInArrow(_cut, "id LONG, kept BINARY, n_bytes LONG, n_removed LONG, n_spans LONG")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes = [], []
        for text, spans in zip(batch.column(1), batch.column(2), strict=True):
            raw = text.as_py().encode()
            if not spans.is_valid:
                kept.append(raw)
                sizes.append((len(raw), 0, 0))
                continue
            start, end = (spans.values.field(k).to_numpy() for k in range(2))
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order])
            new = np.append(True, start[1:] > end[:-1])
            first = np.flatnonzero(new)
            start, end = start[first], end[np.append(first[1:], new.size) - 1]
            cuts = [0, *np.stack([start, end], 1).ravel().tolist(), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
            sizes.append((len(raw), int((end - start).sum()), len(first)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary()), *(pa.array([s[k] for s in sizes], pa.int64()) for k in range(3))],
            ["id", "kept", "n_bytes", "n_removed", "n_spans"],
        )

"""Operator 7: passages of documents that copy or rework benchmark items.

Items of equal words are one, and stand for all their ids at the end. Seeds are the 3-word shingles that few items have, and the LEAST_SEEDS rarest of
every item however many have them; one that holds a word that few items have is strong. Pairs of neighbouring words of an
item, of which one is rare, are weak seeds and are looked for in documents side by side and with one word between: a passage
that scores 0.5 keeps some pairs even where no three words in a row survive. A task marks where its documents have seeds; a join on the seed finds the items; around each group of
seeds of one item whose places run in step, of which one is strong or WEAK_SEEDS of a kind are not, the passage is aligned with the item by Smith-Waterman over words. The score is
the alignment's value as a share of the item aligned with itself, so that an edited copy with
a quarter of its words replaced still scores about 0.6 and unrelated prose about 0.1. `n_seeds` counts the shingles of a passage; one found by pairs alone has 0.

Seeds reach the tasks as arrays if they are few (checked by count), with the items that have them, so that weak seeds that are
in step with no other go at once; else documents send their shingles and pairs to a join. Null or empty texts match nothing. Items of fewer words than `least_words` match
where they stand verbatim, those shorter than a shingle only as a whole document. Repeated rows match each for itself and come out once per id. Of equal scores the first place wins.
Extra columns are not read. A text with seeds from end to end is cut into windows, never into a prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termweave.llm import arrays
from termweave.llm.store import by_ids, stored

SEED_WORDS = 3
# A word or shingle is rare if it stands in no more than this share of the items, or in two of them.
RARE_SHARE = 0.05
# Shingles of an item that are seeds even if many items have them.
LEAST_SEEDS = 16
# Weak seeds of a kind that count as much as a strong one.
WEAK_SEEDS = 3
# Words of a document between which a pair may stand: neighbours, and with one word between.
PAIR_STEPS = (1, 2)
# Weak seeds of more items than this open a region without a look at their items, which would be many rows.
CHECKED_ITEMS = 16
# Seeds up to which (21 MB) they are sent to every executor.
SENT_SEEDS = 1_000_000
MATCH, OTHER, GAP = 2, -1, -1
# Alignments done at once.
BATCH = 256


def item_words(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, words ARRAY<LONG>) of every item with text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for _, data, bounds in arrays.chunks(batch.column(1)):
                hashes, _, _, firsts = arrays.words(data, bounds)
                lists += [hashes[a:b].view(np.int64) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), arrays.list_array(lists, pa.int64())], ["item_id", "words"])

    rows = items.select(F.col(key).cast("long"), F.col(text)).where(F.col(key).isNotNull())
    return rows.mapInArrow(read, "item_id LONG, words ARRAY<LONG>")


def pair_grams(hashes: np.ndarray, of: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of the first word) of two words of one text that are `step` apart; the hash does not tell the step."""
    at = np.flatnonzero(of[:-step] == of[step:])
    return arrays.mix(arrays.mix(hashes[at]) + hashes[at + step]), at


def seeds(words: DataFrame, least_words: int = 0, n: int = SEED_WORDS, share: float = RARE_SHARE) -> DataFrame:
    """(gram, item_id, place, size, pair, strong): the rare shingles and pairs of each item, LEAST_SEEDS of either at least.

    A strong one is a shingle that holds a rare word or is of a short item; size is the item's number of words. Short items have no pairs.
    """
    single = words.select("item_id", F.posexplode("words").alias("place", "word"))
    common = single.groupBy("word").agg(F.count_distinct("item_id").alias("df"))
    n_items = words.agg(F.count_distinct("item_id")).first()[0]
    few = max(2, share * n_items)
    common = common.where(F.col("df") > few).select("word")
    rare = single.join(common, "word", "left_anti").select("item_id", "place")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            out, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for item, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = np.array(row, np.int64).view(np.uint64)
                short = hashes.size < least_words
                found, _ = arrays.word_grams(hashes, np.array([0, hashes.size]), n)
                pairs = pair_grams(hashes, np.zeros(hashes.size), 1)[0] if not short else found[:0]
                for pair, part in ((False, found), (True, pairs)):
                    rows += [(item, hashes.size, pair, short)] * part.size
                    out.append(part.view(np.int64))
                    places.append(np.arange(part.size))
            ids, sizes, pair, short = zip(*rows, strict=True) if rows else ((), (), (), ())
            columns = [np.concatenate(out), pa.array(ids, pa.int64()), np.concatenate(places), pa.array(sizes, pa.int64()), pa.array(pair, pa.bool_()), pa.array(short, pa.bool_())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "item_id", "place", "size", "pair", "short"])

    every = words.mapInArrow(grams, "gram LONG, item_id LONG, place LONG, size LONG, pair BOOLEAN, short BOOLEAN")

    def around(width: int, pair: bool) -> DataFrame:
        """Places of the grams of `width` words that hold a rare word."""
        first = F.greatest(F.col("place") - (width - 1), F.lit(0))
        return rare.select("item_id", F.explode(F.sequence(first, F.col("place"))).alias("place"), F.lit(pair).alias("pair")).distinct()

    held = around(n, False).unionByName(around(2, True)).withColumn("held", F.lit(True))
    spread = every.groupBy("gram").agg(F.count_distinct("item_id").alias("df"))
    rank = F.row_number().over(Window.partitionBy("item_id", "pair").orderBy("df", "gram", "place"))
    every = every.join(spread, "gram").withColumn("rank", rank).join(held, ["item_id", "place", "pair"], "left").fillna(False, ["held"])
    every = every.where(((F.col("df") <= few) & (~F.col("pair") | F.col("held"))) | (F.col("rank") <= LEAST_SEEDS))
    return every.select("gram", "item_id", "place", "size", "pair", (~F.col("pair") & (F.col("short") | F.col("held"))).alias("strong"))


@dataclass
class Sent:
    """Seeds as sorted arrays: the grams, whether each is strong, and the (item, place, size of the item) of each from `begin` on."""

    gram: np.ndarray
    strong: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    place: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(found: DataFrame) -> Sent:
        rows = found.select("gram", "item_id", "place", "size", "strong").toPandas().sort_values("gram")
        gram, begin = np.unique(rows["gram"].to_numpy(np.int64), return_index=True)
        strong = np.logical_or.reduceat(rows["strong"].to_numpy(bool), begin) if gram.size else np.empty(0, bool)
        item = np.unique(rows["item_id"].to_numpy(np.int64), return_inverse=True)[1].astype(np.int32)
        return Sent(gram, strong, np.append(begin, len(rows)), item, rows["place"].to_numpy(np.int32), rows["size"].to_numpy(np.int32))

    def in_step(self, spot: np.ndarray, of: np.ndarray, entry: np.ndarray, reach: int) -> np.ndarray:
        """Which seeds may be of a group: strong ones, those of many items, what is near such a one, and weak ones in step with others.

        Places of one item's seeds in an alignment that scores half run in step to within the item's size, so
        they share one of two bands of twice that width, which lie half a band apart.
        """
        lists = self.begin[entry + 1] - self.begin[entry]
        keep = self.strong[entry] | (lists > CHECKED_ITEMS)
        weak = np.flatnonzero(~keep)
        if keep.any() and weak.size:
            sure = np.flatnonzero(keep)
            after = np.searchsorted(sure, weak)
            near = np.zeros(weak.size, bool)
            for other in (sure[np.maximum(after - 1, 0)], sure[np.minimum(after, sure.size - 1)]):
                near |= (of[other] == of[weak]) & (np.abs(spot[other] - spot[weak]) <= reach)
            keep[weak[near]] = True
        n = lists[weak]
        source = np.repeat(weak, n)
        at = self.begin[entry[source]] + np.arange(source.size) - np.repeat(np.cumsum(n) - n, n)
        item, place, size = self.item[at], self.place[at], self.size[at].astype(np.int64)
        for shift in (0, size):
            band = (spot[source] - place + shift) // (2 * size)
            order = np.lexsort((place, band, item, of[source]))
            head = np.ones(order.size, bool)
            for key in (of[source], item, band):
                key = key[order]
                head[1:] &= key[1:] == key[:-1]
            head[1:] = ~head[1:]
            fresh = head.copy()
            fresh[1:] |= np.diff(place[order]) != 0
            group = np.cumsum(head) - 1
            if order.size:
                keep[source[order[(np.bincount(group, fresh) >= WEAK_SEEDS)[group]]]] = True
        return keep


def _is_in(values: np.ndarray, table: np.ndarray, quick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of `values` that are in the sorted `table`, where there); quick[top 20 bits] is False where none is."""
    at = np.flatnonzero(quick[values.view(np.uint64) >> np.uint64(44)])
    place = np.minimum(np.searchsorted(table, values[at]), table.size - 1)
    hit = table[place] == values[at]
    return at[hit], place[hit]


def regions(docs: DataFrame, key: str, text: str, sent: Sent | None, reach: int, n: int = SEED_WORDS) -> DataFrame:
    """(doc_id, start, words, grams, places): the words around seeds, with the seeds.

    A region without a strong seed needs WEAK_SEEDS. Without `sent` every shingle and pair is a seed. Seeds closer than `reach` words share a region; a region holds 4,096 words of seeds at
    most, and beside them the seeds within `reach` on either side, so that a passage has all its seeds in one region.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sent)
    longest = 4096

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if own is not None:
            quick = np.zeros(1 << 20, bool)
            quick[own.gram.view(np.uint64) >> np.uint64(44)] = True
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows: list[tuple] = []
            words_of: list[np.ndarray] = []
            hits: list[np.ndarray] = []
            places: list[np.ndarray] = []
            for first, data, bounds in arrays.chunks(batch.column(1)):
                hashes, _, _, firsts = arrays.words(data, bounds)
                of = np.repeat(np.arange(firsts.size - 1), np.diff(firsts))
                found, ends = arrays.word_grams(hashes, firsts, n)
                kinds = [(found, np.arange(found.size) + np.repeat(firsts[:-1] - ends[:-1], np.diff(ends)))]
                kinds += [pair_grams(hashes, of, step) for step in PAIR_STEPS]
                if own is not None:
                    hit = [_is_in(gram.view(np.int64), own.gram, quick) if own.gram.size else (np.empty(0, np.int64),) * 2 for gram, _ in kinds]
                    kinds = [(gram[at], spot[at]) for (gram, spot), (at, _) in zip(kinds, hit, strict=True)]
                    entry = np.concatenate([x for _, x in hit])
                gram, spot = (np.concatenate([kind[k] for kind in kinds]) for k in (0, 1))
                order = np.argsort(spot, kind="stable")
                firm = np.ones(spot.size, bool)
                if own is not None:
                    order = order[own.in_step(spot[order], of[spot[order]], entry[order], reach)]
                    firm = own.strong[entry[order]]
                if not order.size:
                    continue
                gram, spot = gram[order].view(np.int64), spot[order]
                own_text = of[spot]
                place = spot - firsts[own_text]
                new = np.ones(spot.size, bool)
                new[1:] = (np.diff(own_text) != 0) | (np.diff(place) > reach) | (place[1:] // longest != place[:-1] // longest)
                heads = np.flatnonzero(new)
                for a, b in zip(heads.tolist(), [*heads[1:].tolist(), spot.size], strict=True):
                    text = own_text[a]
                    a = int(np.searchsorted(spot, max(firsts[text], spot[a] - reach)))
                    b = int(np.searchsorted(spot, min(firsts[text + 1] - 1, spot[b - 1] + reach), "right"))
                    if b - a < WEAK_SEEDS and not firm[a:b].any():
                        continue
                    base, stop = firsts[text], firsts[text + 1]
                    begin = max(base, base + place[a] - reach)
                    end = min(stop, base + place[b - 1] + n + reach)
                    rows.append((names[first + text], int(begin - base)))
                    words_of.append(hashes[begin:end].view(np.int64))
                    hits.append(gram[a:b])
                    places.append(place[a:b] - (begin - base))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    arrays.list_array(words_of, pa.int64()),
                    arrays.list_array(hits, pa.int64()),
                    arrays.list_array(places, pa.int64()),
                ],
                ["doc_id", "start", "words", "grams", "places"],
            )

    rows = docs.select(F.col(key).cast("long"), F.col(text)).where(F.col(key).isNotNull() & F.col(text).isNotNull())
    return rows.mapInArrow(read, "doc_id LONG, start LONG, words ARRAY<LONG>, grams ARRAY<LONG>, places ARRAY<LONG>")


def smith_waterman(passages: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best local score, start, end) in each passage against its item, for all pairs at once.

    One step takes one item word against all passage words: a gap along the passage is a
    running maximum, so a step is a few array operations.
    """
    k, m, n = len(passages), max(map(len, passages)), max(map(len, items))
    a, b = np.zeros((k, m), np.int64), np.zeros((k, n), np.int64)
    used = np.zeros((k, m), bool)
    for i, (x, y) in enumerate(zip(passages, items, strict=True)):
        a[i, : len(x)], used[i, : len(x)], b[i, : len(y)] = x, True, y
    lengths = np.array([len(y) for y in items])
    slope = np.arange(m) * -GAP
    score, begin = np.zeros((k, m + 1), np.int64), np.tile(np.arange(m + 1), (k, 1))
    best, best_start, best_end = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
    rows = np.arange(k)
    for j in range(n):
        live = j < lengths
        step = np.where((a == b[:, j : j + 1]) & used, MATCH, OTHER)
        diagonal, above = score[:, :-1] + step, score[:, 1:] + GAP
        new = np.maximum(np.maximum(diagonal, above), 0)
        start = np.where(new == 0, np.arange(1, m + 1), np.where(diagonal >= above, begin[:, :-1], begin[:, 1:]))
        lifted = new + slope
        reach = np.maximum.accumulate(lifted, 1)
        source = np.maximum.accumulate(np.where(lifted == reach, np.arange(m), 0), 1)
        along = reach - slope
        start = np.where(along > new, np.take_along_axis(start, source, 1), start)
        new = np.maximum(new, along) * used
        score[:, 1:] = np.where(live[:, None], new, score[:, 1:])
        begin[:, 1:] = np.where(live[:, None], start, begin[:, 1:])
        top = new.argmax(1)
        better = live & (new[rows, top] > best)
        best_start = np.where(better, start[rows, top], best_start)
        best_end = np.where(better, top + 1, best_end)
        best = np.where(better, new[rows, top], best)
    return best, best_start, best_end


def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best alignment of each row (doc_id, item_id, start, words, item, n_seeds)."""
    for batch in filter(len, batches):
        n = batch.num_rows
        words, items = (batch.column(k) for k in (3, 4))
        out = [np.zeros(n, np.int64) for _ in range(3)]
        sizes = np.array([len(x) * len(y) for x, y in zip(words, items, strict=True)])
        order = np.argsort(sizes, kind="stable")
        begin = 0
        while begin < n:
            # Pairs of about one size together, a million cells at most.
            end = begin + 1
            while end < n and end - begin < BATCH and (end - begin) * sizes[order[end]] < 1_000_000:
                end += 1
            at = order[begin:end]
            pairs = [(words[int(i)].values.to_numpy(), items[int(i)].values.to_numpy()) for i in at]
            for total, found in zip(out, smith_waterman([p[0] for p in pairs], [p[1] for p in pairs]), strict=True):
                total[at] = found
            begin = end
        full = np.array([MATCH * len(y) for y in items])
        start = batch.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(5), pa.array(out[0] / full), pa.array(start + out[1]), pa.array(start + out[2])],
            ["doc_id", "item_id", "n_seeds", "score", "word_start", "word_end"],
        )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.5,
    least_words: int = 8,
) -> DataFrame:
    """(doc_id, item_id, score, word_start, word_end, n_seeds): the best passage of a document for each item it reaches `threshold` with."""
    spark = docs.sparkSession
    listed = item_words(benchmark, item_key, item_text).where(F.size("words") > 0).withColumn("same", F.xxhash64("words"))
    listed = stored(listed, "items")
    words = stored(listed.select(F.col("same").alias("item_id"), "words").dropDuplicates(["item_id"]), "words")
    found = stored(seeds(words, least_words), "seeds")
    reach = (words.agg(F.max(F.size("words"))).first()[0] or 0) * 5 // 4 + 2
    sent = Sent.of(found) if found.count() <= SENT_SEEDS else None
    areas = stored(regions(docs, key, text, sent, reach), "regions").withColumn("region", F.monotonically_increasing_id())
    hits = areas.select("region", F.explode(F.arrays_zip("grams", "places")).alias("hit")).select("region", F.col("hit.grams").alias("gram"), F.col("hit.places").alias("at"))
    # Seeds of one item whose places in the passage and in the item run in step are one group: those of one of two bands (see Sent.in_step).
    step = F.col("at") - F.col("place")
    band = F.explode(F.array(*(F.struct(F.lit(k).alias("shift"), F.floor((step + F.col("size") * k) / (F.col("size") * 2)).alias("band")) for k in (0, 1)))).alias("band")
    hits = hits.join(found, "gram").select("*", step.alias("step"), band)
    hits = hits.groupBy("region", "item_id", "band").agg(
        F.count_distinct(F.when(~F.col("pair"), F.col("at"))).alias("n_seeds"),
        F.count_distinct(F.when(~F.col("pair"), F.col("place"))).alias("n_shingles"),
        F.count_distinct(F.when(F.col("pair"), F.col("place"))).alias("n_pairs"),
        F.min("step").alias("low"),
        F.max("step").alias("high"),
        F.max("strong").alias("strong"),
    ).where(F.col("strong") | (F.col("n_shingles") >= WEAK_SEEDS) | (F.col("n_pairs") >= WEAK_SEEDS))
    # Bands with the same seeds are aligned once.
    hits = hits.groupBy("region", "item_id").agg(F.collect_set(F.struct("n_seeds", "low", "high")).alias("groups"))
    hits = hits.select("region", "item_id", F.explode("groups").alias("g")).select("region", "item_id", "g.*")
    pairs = hits.join(areas.select("region", "doc_id", "start", "words"), "region").join(words.withColumnRenamed("words", "item"), "item_id")
    slack = F.ceil(F.size("item") / 4).cast("long") + 1
    low = F.greatest(F.col("low") - slack, F.lit(0))
    high = F.least(F.col("high") + F.size("item") + slack, F.size("words").cast("long"))
    pairs = pairs.select(
        "doc_id",
        "item_id",
        (F.col("start") + low).alias("start"),
        F.slice("words", (low + 1).cast("int"), (high - low).cast("int")).alias("words"),
        "item",
        "n_seeds",
    )
    scored = pairs.mapInArrow(align, "doc_id LONG, item_id LONG, n_seeds LONG, score DOUBLE, word_start LONG, word_end LONG")
    short = words.where(F.size("words") < least_words).select("item_id", F.lit(True).alias("short"))
    least = F.when(F.col("short"), F.lit(1.0)).otherwise(F.lit(float(threshold)))
    scored = scored.where(F.col("score") >= threshold).join(short, "item_id", "left").where(F.col("score") >= least)
    best = F.max_by(F.struct("score", "word_start", "word_end", "n_seeds"), F.struct("score", -F.col("word_start"))).alias("x")
    scored = scored.groupBy("doc_id", F.col("item_id").alias("same")).agg(best).select("doc_id", "same", "x.*")
    return scored.join(listed.select("same", "item_id").distinct(), "same").groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.*")


def clean_documents(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents without a contaminated passage; rows without an id stay."""
    return by_ids(docs, key, found.select("doc_id"), "left_anti")

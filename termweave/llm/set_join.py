"""Operator 1: exact Jaccard join of word-shingle sets by set-relation skipping.

1. Sets that are equal stand as one (the smallest id), so exact copies cost nothing further.
2. Every set indexes its prefix: with similarity num/den two linked sets share a shingle of
   the first `size - ceil(size * num / den) + 1` in one order of all shingles. The order is
   by hash, with the most frequent shingles of the corpus last; it decides speed, never results.
3. Relations: a set is compared with one leader, and keeps how many shingles it has and the
   leader lacks, and the other way round. Sets that the leader does not tie are compared with all others of that leader,
   in blocks, so pairs of one leader are decided. All sets tied by links are one class.
4. Index skipping: in a list, entries with the same size, place, class, leader and number in lists are one block. A
   pair of blocks is skipped if the sizes or the places are too far apart for the required overlap, if
   too few shingles of either are in lists, or if class or leader is the same. What remains stands as its pair of
   leaders, once, however many sets they have, and goes if the prefixes share too few shingles for any of them.
5. Answer skipping: the pairs left are compared. With the kept differences the overlap of two leaders bounds
   that of every pair below. Where the widest bounds of both groups refuse, or accept and each group is one class, no set is
   looked at. Otherwise the sets of the smaller group that the bounds leave open visit the blocks of the other, as in 3.

A set is an array of 64-bit shingle hashes. Null or empty texts have no shingle and link with nothing;
rows that share an id are one node; rows without an id come out with a null component. Ties
(equal sizes, equal texts) go to the smaller id. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays
from termweave.llm.store import components, stored

# Shingles that the order puts last: the most frequent ones, half a megabyte at any input size.
FREQUENT = 65_536
# Sets in which a shingle must be to count as frequent.
FREQUENT_FROM = 200
# Shingles counted at once.
COUNTED = 1_000_000
# A set has a leader if one is proposed by every third place of its prefix.
LEADER_SHARE = 3
# Sets of one leader in a block.
GROUP_BLOCK = 250
# Pairs told at once, those looked at at once (some twenty numbers stand for each), and ids up to which (4 MB) a list of ids is sent to every executor.
PAIRS = 1_000_000
LOOKED_AT = 250_000
SENT_IDS = 500_000


def frequent_shingles(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """The most frequent shingles, rarest first: at most FREQUENT.

    A task counts its own texts and reports what it saw twice; a shingle frequent enough to
    matter is seen twice by most tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("set_join")
        held: list[np.ndarray] = []
        size = 0

        def report() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(found[keep]), pa.array(counts[keep])], ["shingle", "n"])

        for batch in batches:
            for _, grams in arrays.shingle_sets(batch.column(0), n):
                held.append(grams)
                size += grams.size
                if size >= COUNTED:
                    yield report()
                    held, size = [], 0
        if size:
            yield report()

    counted = docs.select(text).mapInArrow(count, "shingle LONG, n LONG")
    top = counted.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_FROM)
    rows = top.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    return rows["shingle"].to_numpy(np.int64)[::-1].copy()


class Order:
    """Puts frequent shingles last."""

    def __init__(self, frequent: np.ndarray):
        by = np.argsort(frequent)
        self.names, self.rank = frequent[by], by
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[frequent.view(np.uint64) >> np.uint64(44)] = True

    def prefix(self, grams: np.ndarray, length: int) -> np.ndarray:
        """The first `length` of sorted shingles."""
        if not self.names.size:
            return grams[:length]
        at = np.flatnonzero(self.maybe[grams.view(np.uint64) >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.names, grams[at]), self.names.size - 1)
        hit = self.names[place] == grams[at]
        late = np.zeros(grams.size, bool)
        late[at[hit]] = True
        first = grams[~late][:length]
        if first.size == length:
            return first
        last = grams[at[hit]][np.argsort(self.rank[place[hit]], kind="stable")]
        return np.concatenate([first, last[: length - first.size]])


def least(size: int, num: int, den: int) -> int:
    """The smallest overlap, and the smallest size, of a set linked to one of `size`."""
    return -(-size * num // den)


def read_sets(docs: DataFrame, key: str, text: str, n: int, num: int, den: int) -> DataFrame:
    """(id, size, high, low, prefix) of every row; high and low are the set's 128-bit digest."""
    order = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, text, n))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("set_join")
        sort = Order(order.value)
        for batch in filter(len, batches):
            sizes, digests, prefixes = [], [], []
            for _, grams in arrays.shingle_sets(batch.column(1), n):
                sizes.append(grams.size)
                digests.append(xxhash.xxh3_128_digest(grams.tobytes()))
                length = grams.size - least(grams.size, num, den) + 1 if grams.size else 0
                prefixes.append(sort.prefix(grams, length))
            digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.ascontiguousarray(digest[:, 0])),
                    pa.array(np.ascontiguousarray(digest[:, 1])),
                    arrays.list_array(prefixes, pa.int64()),
                ],
                ["id", "size", "high", "low", "prefix"],
            )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(read, "id LONG, size LONG, high LONG, low LONG, prefix ARRAY<LONG>")


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}


def _joined(held: dict[str, np.ndarray] | None, new: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return new if held is None else {k: np.concatenate([held[k], new[k]]) for k in new}


def live_entries(num: int, den: int):
    """mapInArrow function: entries sorted by (token, size, id) that have a neighbour of a fitting size.

    Sizes in a list ascend, so a set has a partner of fitting size only if one of its two
    neighbours fits.
    """
    names = ["token", "id", "size", "place"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("set_join")
        last: dict[str, np.ndarray] | None = None  # the entry before this batch, still to be decided
        fits = False
        for batch in filter(len, batches):
            x = _joined(last, _columns(batch))
            token, size = x["token"], x["size"]
            need = -(-size * num // den)
            near = np.zeros(token.size + 1, bool)
            near[1:-1] = (token[1:] == token[:-1]) & (size[:-1] >= need[1:])
            near[0] = fits
            out = np.flatnonzero((near[:-1] | near[1:])[:-1])
            if out.size:
                yield pa.RecordBatch.from_arrays([pa.array(x[k][out]) for k in names], names)
            fits = bool(near[-2])
            last = {k: v[-1:] for k, v in x.items()}
        if last is not None and fits:
            yield pa.RecordBatch.from_arrays([pa.array(last[k]) for k in names], names)

    return keep


def group_links(num: int, den: int):
    """mapInArrow function over (ref, salt, visitor, tied, id, grams) in that order: links of visitors to residents.

    Residents of a block come first and are held, their shingles as one sorted list; a visitor
    looks its own up there and gets its overlap with every resident at once. It reports one link for each
    class of residents that it links with, and makes them one class.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("set_join")
        block: tuple | None = None
        ids: list[int] = []
        held: list[np.ndarray] = []
        ties: list[bool] = []
        state: dict[str, np.ndarray] = {}
        for batch in batches:
            ref, salt, visitor, tied, names = (batch.column(k).to_pylist() for k in range(5))
            pairs: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                if block != (ref[k], salt[k]):
                    block = (ref[k], salt[k])
                    ids, held, ties, state = [], [], [], {}
                grams = batch.column(5)[k].values.to_numpy()
                if not visitor[k]:
                    ids.append(names[k])
                    held.append(grams)
                    ties.append(tied[k])
                    continue
                if not ids:
                    continue
                if not state:
                    size = np.array([g.size for g in held])
                    flat = np.concatenate(held)
                    order = np.argsort(flat, kind="stable")
                    root = np.where(ties, -1, np.arange(size.size))
                    state = {"size": size, "token": flat[order], "owner": np.repeat(np.arange(size.size), size)[order], "root": root, "id": np.array(ids)}
                low, high = (np.searchsorted(state["token"], grams, side) for side in ("left", "right"))
                n = high - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                common = np.bincount(state["owner"][at], minlength=state["size"].size)
                met = np.flatnonzero((common * (num + den) >= num * (state["size"] + grams.size)) & (state["id"] != names[k]))
                roots, first = np.unique(state["root"][met], return_index=True)
                pairs += [(names[k], int(state["id"][m])) for m in met[first]]
                if roots.size > 1:
                    state["root"][np.isin(state["root"], roots)] = roots[0]
            yield pa.RecordBatch.from_arrays([pa.array([p[j] for p in pairs], pa.int64()) for j in range(2)], ["a", "b"])

    return read


def candidate_pairs(num: int, den: int):
    """mapInArrow function: (a, b, need, led, shared) of entries sorted by (token, size, place, class, leader), by blocks.

    A set that has a leader stands as its leader, and `led` tells whether either has or is one. `shared` counts the shingles that any sets of
    the pair meet in, and linked ones meet in `need` at least. Pairs of one class are tied, and pairs of one leader decided
    already. Only entries of the open list whose size can still matter are held.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("set_join")
        held: dict[str, np.ndarray] | None = None
        found: list[np.ndarray] = []
        n_found = 0

        def report() -> pa.RecordBatch:
            rows = np.concatenate(found)
            rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
            # A pair counts once a shingle, with the least that any of its sets need.
            same = (rows[1:, :3] == rows[:-1, :3]).all(1)
            rows = rows[np.append(True, ~same)]
            first = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1)))
            counts = np.diff(np.append(first, len(rows)))
            need, led = np.minimum.reduceat(rows[:, 3], first), np.maximum.reduceat(rows[:, 4], first) > 0
            columns = [rows[first, 0], rows[first, 1], need, led, counts]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["a", "b", "need", "led", "shared"])

        for batch in filter(len, batches):
            new = _columns(batch)
            n_held = 0 if held is None else held["token"].size
            x = _joined(held, new)
            token, size, place, group = x["token"], x["size"], x["place"], x["root"]
            # Blocks of equal token, size, place and class; held entries were paired before.
            change = np.zeros(token.size, bool)
            change[0] = True
            for column in (token, size, place, group, x["ref"], x["listed"]):
                change[1:] |= np.diff(column) != 0
            if n_held < token.size:
                change[n_held] = True
            starts = np.flatnonzero(change)
            b_token, b_size, b_place, b_root, b_ref, b_listed = (v[starts] for v in (token, size, place, group, x["ref"], x["listed"]))
            is_new = starts >= n_held
            need = -(-b_size * num // den)
            # Blocks of the same token are adjacent and ascend in size: the first that is large enough, by bisection.
            list_at = np.searchsorted(b_token, b_token, "left") if token.size else starts
            low = list_at.copy()
            high = np.arange(starts.size)
            while True:
                open_ = low < high
                if not open_.any():
                    break
                mid = (low + high) // 2
                small = open_ & (b_size[np.minimum(mid, starts.size - 1)] < need)
                low = np.where(small, mid + 1, low)
                high = np.where(open_ & ~small, mid, high)
            counts = np.where(is_new, np.arange(starts.size) - low, 0)
            begin = 0
            while begin < starts.size:
                total = np.cumsum(counts[begin:])
                stop = begin + max(1, int(np.searchsorted(total, LOOKED_AT, "right")))
                right = np.repeat(np.arange(begin, stop), counts[begin:stop])
                if right.size:
                    first = np.repeat(np.cumsum(counts[begin:stop]) - counts[begin:stop], counts[begin:stop])
                    left = low[right] + np.arange(right.size) - first
                    required = -(-(b_size[left] + b_size[right]) * num // (num + den))
                    # Before a shingle that linked sets share, either has no more of its own than it may have in all.
                    apart = b_place[left] - b_place[right]
                    ok = (apart <= b_size[left] - required) & (-apart <= b_size[right] - required)
                    # Beyond the prefixes at most `after` are shared, in them no more than either has in lists.
                    after = -(-np.maximum(b_size[left], b_size[right]) * num // den) - 1
                    ok &= np.minimum(b_listed[left], b_listed[right]) + after >= required
                    ok &= (b_root[left] != b_root[right]) & (b_ref[left] != b_ref[right])
                    left, right, need = left[ok], right[ok], (required - after)[ok]
                    one, two = starts[left], starts[right]
                    # Blocks of sets without a leader have one entry.
                    led = x["led"][one] | x["led"][two]
                    swap = x["ref"][one] > x["ref"][two]
                    a, b = np.where(swap, two, one), np.where(swap, one, two)
                    found.append(np.stack([x["ref"][a], x["ref"][b], x["token"][a], need, led], 1))
                    n_found += a.size
                    if n_found >= PAIRS:
                        yield report()
                        found, n_found = [], 0
                begin = stop
            # Two entries of one block have one class and are tied already.
            stay = (token == token[-1]) & (-(-size[-1] * num // den) <= size)
            held = {k: v[stay] for k, v in x.items()}
        if n_found:
            yield report()

    return pairs


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b, ...) with size_a, size_b and the size of their intersection."""
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("grams_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.withColumns(
        {
            "size_a": F.size("grams_a").cast("long"),
            "size_b": F.size("grams_b").cast("long"),
            "common": F.size(F.array_intersect("grams_a", "grams_b")).cast("long"),
        }
    ).drop("grams_a", "grams_b")


def linked(common: Column | str, size_a: Column | str, size_b: Column | str, num: int, den: int) -> Column:
    """Whether an intersection is large enough: (num + den) * common >= num * (size_a + size_b)."""
    as_col = [F.col(x) if isinstance(x, str) else x for x in (common, size_a, size_b)]
    return as_col[0] * (num + den) >= (as_col[1] + as_col[2]) * num


def whole_sets(docs: DataFrame, ids: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(id, grams) of some documents: their whole sets."""
    ids = stored(ids.select(F.col("id").alias("asked")).distinct(), "ids")
    sent = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    texts = texts.join(sent, F.col("id") == F.col("asked"), "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("set_join")
        for batch in batches:
            lists: list[np.ndarray] = []
            size = done = 0
            for k, grams in arrays.shingle_sets(batch.column(1), n):
                lists.append(grams)
                size += grams.size
                if size >= COUNTED or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(lists)), arrays.list_array(lists, pa.int64())], ["id", "grams"])
                    lists, size, done = [], 0, k + 1

    found = texts.mapInArrow(read, "id LONG, grams ARRAY<LONG>").where("size(grams) > 0")
    return stored(found, "grams")


def jaccard_join(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, num: int = 4, den: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(links, members) of all rows; similarity num/den or more of n-word shingles.

    links(a, b): links that tie each component together, among sets that stand for their
    copies; members(id, n_shingles, rep): every row with the smallest id of equal sets.
    """
    rows = stored(read_sets(docs, key, text, n, num, den), "sets")
    reps = rows.where("size > 0 AND id IS NOT NULL").groupBy("high", "low").agg(F.min("id").alias("rep"))
    reps = stored(reps, "reps")
    members = rows.select("id", "size", "high", "low").join(reps, ["high", "low"], "left")
    members = members.select("id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("rep")).alias("rep"))

    whole = rows.where("size > 0").join(reps.select("high", "low", F.col("rep").alias("id")), ["high", "low", "id"], "left_semi")
    whole = whole.dropDuplicates(["id", "high", "low"])
    entries = whole.select("id", "size", F.posexplode("prefix").alias("place", "token")).select("token", "id", "size", F.col("place").cast("long").alias("place"))
    listed = entries.repartition("token").sortWithinPartitions("token", "size", "id")
    live = stored(
        listed.mapInArrow(live_entries(num, den), "token LONG, id LONG, size LONG, place LONG"), "entries"
    )

    # Relations. A set's leader is, among sets of about its size in the lists of its prefix, the one with
    # the largest share of its prefix in lists at all: the text that others were made from. Two ways to
    # band the sizes let sets on either side of an edge meet; a list has few bands.
    length = F.col("size") - F.ceil(F.col("size") * num / den - 1e-9) + 1
    listed = live.groupBy("id").agg(F.count(F.lit(1)).alias("listed"), F.max(length).alias("of"))
    share = listed.select("id", (F.col("listed") / F.col("of")).alias("share"))
    band = F.log(F.col("size")) / math.log(den / num) + 1e-9
    bands = F.array(F.floor(band), -1 - F.floor(band + 0.5))
    shared = live.join(share, "id").select("token", "id", "share", F.explode(bands).alias("band"))
    top = shared.groupBy("token", "band").agg(F.max(F.struct("share", (-F.col("id")).alias("minus"))).alias("top"))
    top = top.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("band", -F.col("top.minus")))).alias("leaders"))
    both = F.array_distinct(F.transform(bands, lambda x: F.element_at("leaders", x)))
    proposed = live.join(top, "token").select("id", length.alias("of"), F.explode(both).alias("leader")).where("leader <> id")
    best = proposed.groupBy("id", "leader").agg(F.count(F.lit(1)).alias("n"), F.max("of").alias("of"))
    best = best.where(F.col("n") * LEADER_SHARE >= F.col("of")).groupBy("id")
    best = best.agg(F.max(F.struct("n", (-F.col("leader")).alias("minus"))).alias("top"))
    best = stored(best.select(F.col("id").alias("b"), (-F.col("top.minus")).alias("a")), "leaders")
    sets = whole_sets(docs, best.select(F.col("a").alias("id")).unionByName(best.select(F.col("b").alias("id"))), key, text, n)
    met = overlaps(best, sets).groupBy("b").agg(F.max_by(F.struct("a", "size_a", "size_b", "common"), "common").alias("x")).select("b", "x.*")
    met = stored(met.withColumn("tied", linked("common", "size_a", "size_b", num, den)), "met")

    # Within the sets of one leader, those it does not tie are compared with all.
    group = met.select("b", F.col("a").alias("ref"), "tied").unionByName(met.select(F.col("a").alias("b"), F.col("a").alias("ref"), F.lit(True).alias("tied")).distinct())
    sizes = group.groupBy("ref").agg(F.count(F.lit(1)).alias("members"), F.count_if(~F.col("tied")).alias("loose")).where("loose > 0 AND members > 2")
    group = group.join(sizes.select("ref", F.ceil(F.col("members") / GROUP_BLOCK).cast("int").alias("salts")), "ref")
    group = stored(group.join(sets.withColumnRenamed("id", "b"), "b"), "members")
    group = group.withColumnRenamed("b", "id")
    residents = group.withColumns({"salt": F.pmod(F.xxhash64("id"), "salts").cast("int"), "visitor": F.lit(False)})
    visitors = group.where("NOT tied").withColumns({"salt": F.explode(F.sequence(F.lit(0), F.col("salts") - 1)), "visitor": F.lit(True)})
    tied = stored(met.where("tied").select("a", "b").unionByName(_met(residents.unionByName(visitors), num, den)), "tied")
    classes = components(tied).withColumnRenamed("component", "root")
    leaders = met.select(F.col("a").alias("id")).distinct().join(classes, "id", "left_anti")
    classes = classes.unionByName(leaders.select("id", F.col("id").alias("root")))
    relation = met.select(F.col("b").alias("id"), F.col("a").alias("leader"), (F.col("size_b") - F.col("common")).alias("more"), (F.col("size_a") - F.col("common")).alias("less"))
    relation = relation.join(classes, "id", "full").select(
        "id", F.coalesce("root", "id").alias("root"), F.coalesce("leader", "id").alias("leader"), F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("less", F.lit(0)).alias("less")
    )
    relation = stored(relation, "classes")

    # Index skipping. A set is led if it has a leader or is one.
    refs = relation.where("leader <> id").select(F.col("leader").alias("ref"), F.lit(True).alias("led")).distinct()
    placed = live.join(listed.select("id", "listed"), "id").join(relation.select("id", "root", F.col("leader").alias("ref")), "id", "left")
    placed = placed.select("token", "id", "size", "place", "listed", F.coalesce("root", "id").alias("root"), F.coalesce("ref", "id").alias("ref"))
    placed = placed.join(refs, "ref", "left").withColumn("led", F.col("led").isNotNull())
    placed = placed.repartition("token").sortWithinPartitions("token", "size", "place", "root", "ref", "listed", "id")
    pairs = placed.mapInArrow(candidate_pairs(num, den), "a LONG, b LONG, need LONG, led BOOLEAN, shared LONG")
    pairs = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need"), F.max("led").alias("led"))
    pairs = stored(pairs.where("shared >= need").select("a", "b", "led"), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = sets.unionByName(whole_sets(docs, ids.join(sets.select("id"), "id", "left_anti"), key, text, n))
    lack = num * (F.col("size_a") + F.col("size_b")) - (num + den) * F.col("common")
    answers = stored(overlaps(pairs, sets).select("a", "b", "led", lack.alias("lack")), "answers")
    links = tied.unionByName(answers.where("lack <= 0").select("a", "b"))

    # Answer skipping. With what a set has more and less than its leader, a pair lacks at least `lack` less the sum of both `gain`.
    gain = den * F.col("more") + num * F.col("less")
    below = relation.join(refs, F.col("leader") == F.col("ref"), "left_semi").select(F.col("leader").alias("ref"), "id", "root", gain.alias("gain"))
    heads = below.select(F.col("ref").alias("id")).distinct().join(relation.select("id", "root"), "id", "left").select("id", F.coalesce("root", "id").alias("head_root"))
    below = stored(below.join(heads.withColumnRenamed("id", "ref"), "ref").withColumn("tied", F.col("root") == F.col("head_root")), "below")
    groups = below.groupBy("ref").agg(F.count(F.lit(1)).alias("n"), F.max("gain").alias("gain"), F.min("tied").alias("one_class"))
    open_ = answers.where("led")
    for side in "ab":
        named = groups.select(F.col("ref").alias(side), F.col("n").alias(f"n_{side}"), F.col("gain").alias(f"gain_{side}"), F.col("one_class").alias(f"one_{side}"))
        open_ = open_.join(named, side, "left").fillna({f"n_{side}": 1, f"gain_{side}": 0}).withColumn(f"one_{side}", F.coalesce(f"one_{side}", F.lit(True)))
    open_ = open_.where("lack <= gain_a + gain_b AND (lack > 0 OR NOT one_a OR NOT one_b)")
    b_visits = F.col("n_b") <= F.col("n_a")
    visits = stored(
        open_.select(
            F.when(b_visits, F.col("b")).otherwise(F.col("a")).alias("guest"),
            F.when(b_visits, F.col("a")).otherwise(F.col("b")).alias("ref"),
            F.when(b_visits, F.col("n_a")).otherwise(F.col("n_b")).alias("members"),
            (F.col("lack") - F.when(b_visits, F.col("gain_a")).otherwise(F.col("gain_b"))).alias("least"),
        ),
        "visits",
    )
    # A set that no other has as its leader is a group of its own.
    alone = visits.select(F.explode(F.array("guest", "ref")).alias("ref")).distinct().join(groups, "ref", "left_anti")
    below = below.select("ref", "id", "gain", "tied").unionByName(alone.select("ref", F.col("ref").alias("id"), F.lit(0).alias("gain"), F.lit(True).alias("tied")))
    salts = F.ceil(F.col("members") / GROUP_BLOCK).cast("int")
    guests = visits.join(below.select(F.col("ref").alias("guest"), "id", "gain"), "guest").where("gain >= least").select("ref", "id", salts.alias("salts")).distinct()
    hosts = below.join(visits.select("ref", salts.alias("salts")).distinct(), "ref")
    hosts = hosts.select("ref", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"), F.lit(False).alias("visitor"), "tied", "id")
    guests = guests.select("ref", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("visitor"), F.lit(False).alias("tied"), "id")
    met = stored(_met(hosts.unionByName(guests).join(sets, "id"), num, den), "visited")
    return links.unionByName(met), members


def _met(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links of visitors to residents, of rows (ref, salt, visitor, tied, id, grams)."""
    blocks = rows.select("ref", "salt", "visitor", "tied", "id", "grams").repartition("ref", "salt").sortWithinPartitions("ref", "salt", "visitor")
    return blocks.mapInArrow(group_links(num, den), "a LONG, b LONG")


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, num: int = 4, den: int = 5
) -> DataFrame:
    """(id, n_shingles, component): the smallest id reachable over links, for every row of `docs`."""
    links, members = jaccard_join(docs, key, text, n, num, den)
    found = components(links).withColumnRenamed("id", "rep")
    return members.join(found, "rep", "left").select(
        "id", "n_shingles", F.coalesce("component", "rep", "id").alias("component")
    )

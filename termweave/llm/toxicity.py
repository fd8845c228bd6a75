"""Operator 4: toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased words and their heads of five letters. The vocabulary is what the
labelled examples can tell apart: terms whose log odds between the labels are large. The
examples form an inverted index cut into blocks of 64; a block keeps the highest weight of
each term. For a text the blocks' bounds are summed, blocks are read from the highest
bound on, and reading stops when no block left can reach the k-th best cosine found, so the k
nearest are exact. Votes are weighted by closeness, with a fixed vote of the base rate, which makes
the score fall back to that rate where nothing is near; a table from cross-fitted scores to observed
rates calibrates it. The nearest examples are kept as evidence.

The examples are a bounded sample of the labelled rows (EXAMPLES, documented), the lowest by hash.
Null and empty texts and texts without a term score the base rate of such texts. Ties in cosine go to the
example with the smaller number. Repeated rows score alike; whole texts are read; extra columns are not.
Without labelled rows every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays

# Labelled rows that are learned from: 12,000 of some 3 KB each are read once on the driver's side of a job.
EXAMPLES = 12_000
# Terms of the vocabulary: those with the largest log odds that this many toxic examples share.
TERMS = 2_048
LEAST_EXAMPLES = 5
LEAST_LOG_ODDS = 1.5
BLOCK = 64
NEIGHBOURS = 15
# The weight of the base rate among the votes.
PRIOR_VOTE = 0.5
BINS = 20
_LETTER = np.ones(256, bool)
_LETTER[:0x80] = False
for _a, _b in (("a", "z"), ("A", "Z"), ("0", "9")):
    _LETTER[ord(_a) : ord(_b) + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
HEAD = 5


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term hash) of every word and of the head of every longer word."""
    starts, ends = arrays.runs(_LETTER[data], bounds)
    values = arrays.byte_values(_LOWER[data])
    # A head ends between characters, so that it never cuts one.
    cut = np.minimum(starts + HEAD, ends)
    while True:
        inside = (cut < ends) & ((data[np.minimum(cut, max(data.size - 1, 0))] & 0xC0) == 0x80) if data.size else np.zeros(0, bool)
        if not inside.any():
            break
        cut = cut + inside
    text = np.searchsorted(bounds, starts, "right") - 1
    long = cut < ends
    whole = arrays.span_hashes(values, starts, ends)
    head = arrays.mix(arrays.span_hashes(values, starts[long], cut[long]) + np.uint64(1))
    return np.concatenate([text, text[long]]), np.concatenate([whole, head])


def count_terms(data: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of distinct pairs; with a vocabulary, term numbers of its members only."""
    text, term = terms(data, bounds)
    if vocabulary is not None:
        if not vocabulary.size:
            return (np.empty(0, np.int64),) * 3
        quick = np.zeros(1 << 16, bool)
        quick[vocabulary >> np.uint64(48)] = True
        may = np.flatnonzero(quick[term >> np.uint64(48)])
        at = np.minimum(np.searchsorted(vocabulary, term[may]), vocabulary.size - 1)
        hit = vocabulary[at] == term[may]
        text, at = text[may[hit]], at[hit]
        pair, count = np.unique(text * vocabulary.size + at, return_counts=True)
        return pair // vocabulary.size, pair % vocabulary.size, count
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    new = np.ones(text.size, bool)
    new[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return text[at], term[at], np.diff(np.append(at, text.size))


@dataclass
class Index:
    """Block-max inverted index of unit TF-IDF vectors."""

    vocabulary: np.ndarray
    idf: np.ndarray
    label: np.ndarray
    # Postings by (term, block): where they start, the example in the block, the weight; the highest weight of each.
    begin: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    highest: np.ndarray
    n_blocks: int
    rate: float = 0.0
    levels: np.ndarray | None = None

    @staticmethod
    def build(vocabulary: np.ndarray, idf: np.ndarray, text: np.ndarray, term: np.ndarray, count: np.ndarray, label: np.ndarray) -> Index:
        value = (1 + np.log(count)) * idf[term] if count.size else np.empty(0)
        norm = np.sqrt(np.bincount(text, value**2, label.size)) if count.size else np.zeros(label.size)
        value = value / norm[text] if count.size else value
        n_blocks = max(1, -(-label.size // BLOCK))
        slot = term * n_blocks + text // BLOCK
        order = np.lexsort((text, slot))
        slot = slot[order]
        begin = np.searchsorted(slot, np.arange(vocabulary.size * n_blocks + 1))
        highest = np.zeros(vocabulary.size * n_blocks)
        np.maximum.at(highest, slot, value[order])
        return Index(vocabulary, idf, label, begin, (text % BLOCK)[order], value[order], highest.reshape(-1, n_blocks), n_blocks)

    def nearest(self, term: np.ndarray, count: np.ndarray, k: int = NEIGHBOURS, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the k nearest with a cosine above 0, best first; `skip` is left out."""
        value = (1 + np.log(count)) * self.idf[term]
        value = value / np.sqrt((value**2).sum())
        bound = value @ self.highest[term]
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound)]
        best, score = np.empty(0, np.int64), np.empty(0)
        step = 0
        while step < order.size:
            # A few blocks at a time; what is left can reach no more than the next bound.
            if best.size == k and bound[order[step]] < score[-1]:
                break
            blocks = order[step : step + 4]
            step += 4
            for block in blocks:
                slots = term * self.n_blocks + block
                total = np.zeros(BLOCK)
                for v, a, b in zip(value, self.begin[slots], self.begin[slots + 1], strict=True):
                    total[self.example[a:b]] += v * self.weight[a:b]
                hit = np.flatnonzero(total)
                name = hit + block * BLOCK
                keep = name != skip
                best, score = np.append(best, name[keep]), np.append(score, total[hit][keep])
            top = np.lexsort((best, -np.round(score, 12)))[:k]
            best, score = best[top], score[top]
        return best, score

    def vote(self, example: np.ndarray, cosine: np.ndarray) -> float:
        """Share of toxic votes: each of a neighbour's closeness, and the base rate with a fixed weight."""
        closeness = 1 / (1.05 - np.minimum(cosine, 1.0))
        votes = closeness * cosine
        return float(((votes * self.label[example]).sum() + PRIOR_VOTE * self.rate) / (votes.sum() + PRIOR_VOTE))

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.levels[0], self.levels[1]) if self.levels is not None else raw


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES) -> Index:
    """The index of labelled examples: the `examples` labelled rows that come first by hash."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64(key), key).limit(examples)
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(chosen), key)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in arrays.chunks(batch.column(1)):
                n = len(bounds) - 1
                of, term, count = count_terms(data, bounds, None)
                ends = np.searchsorted(of, np.arange(n + 1))
                lists = [term[a:b].view(np.int64) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                counts = [count[a:b].astype(np.int64) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(2).slice(first, n), arrays.list_array(lists, pa.int64()), arrays.list_array(counts, pa.int64())],
                    ["id", "label", "terms", "counts"],
                )

    # Terms of the examples, with how many of either label have them: one aggregate, rare terms dropped in Spark.
    kind = docs.schema[key].dataType.simpleString()
    bags = rows.select(key, "text", "label").mapInArrow(read, f"id {kind}, label INT, terms ARRAY<LONG>, counts ARRAY<LONG>").persist()
    try:
        sizes = {r["label"]: r["n"] for r in bags.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_bad, n_all = sizes.get(1, 0), sum(sizes.values())
        n_good = n_all - n_bad
        seen = bags.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("df"))
        odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("df") - F.col("bad") + 0.5) / (n_good + 1))
        told = seen.where(F.col("bad") >= LEAST_EXAMPLES).where(odds >= LEAST_LOG_ODDS).orderBy(F.desc(odds * F.sqrt("bad")), "term").limit(TERMS)
        picked = told.toPandas()
        vocabulary = picked["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(vocabulary)
        vocabulary, df = vocabulary[order], picked["df"].to_numpy(float)[order]
        idf = np.log((1 + n_all) / (1 + df)) + 1
        # Only terms of the vocabulary come to the driver.
        wanted = set(vocabulary.view(np.int64).tolist())
        small = bags.select("id", "label", F.arrays_zip("terms", "counts").alias("pairs"))
        names = docs.sparkSession.createDataFrame([(int(t),) for t in wanted], "term LONG")
        pairs = small.select("id", "label", F.explode("pairs").alias("p")).select("id", "label", F.col("p.terms").alias("term"), F.col("p.counts").alias("n"))
        bag = pairs.join(F.broadcast(names), "term").toPandas()
        people = bags.select("id", "label").orderBy("id").toPandas()
    finally:
        bags.unpersist()
    number = {name: k for k, name in enumerate(people["id"])}
    of = bag["id"].map(number).to_numpy(np.int64) if len(bag) else np.empty(0, np.int64)
    term = np.searchsorted(vocabulary, bag["term"].to_numpy(np.int64).view(np.uint64)) if len(bag) else np.empty(0, np.int64)
    index = Index.build(vocabulary, idf, of, term, bag["n"].to_numpy(np.int64) if len(bag) else np.empty(0, np.int64), people["label"].to_numpy(np.int64))
    # The base rate is that of examples without a term, which neighbours say nothing about.
    bare = np.bincount(of, minlength=len(people)) == 0
    index.rate = float((people["label"][bare].sum()) / (bare.sum() + 1)) if len(people) else 0.0
    index.levels = _levels(index, of, term, bag["n"].to_numpy(np.int64) if len(bag) else np.empty(0, np.int64))
    return index


def _levels(index: Index, of: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray | None:
    """Observed rates by raw score, from examples scored without themselves: rising, with one step a bin."""
    if not of.size:
        return None
    order = np.argsort(of, kind="stable")
    of, term, count = of[order], term[order], count[order]
    names, begin = np.unique(of, return_index=True)
    ends = np.append(begin[1:], of.size)
    raw = np.array([index.vote(*index.nearest(term[a:b], count[a:b], skip=int(k))) for k, a, b in zip(names, begin, ends, strict=True)])
    label = index.label[names]
    edges = np.unique(np.quantile(raw, np.linspace(0, 1, BINS + 1)))
    at = np.clip(np.searchsorted(edges, raw, "right") - 1, 0, max(edges.size - 2, 0))
    n = np.bincount(at)
    centre, rate = np.bincount(at, raw) / np.maximum(n, 1), (np.bincount(at, label) + index.rate) / (n + 1)
    use = n > 0
    # Pooled until they rise.
    groups: list[list[float]] = []
    for c, r, w in zip(centre[use], rate[use], n[use], strict=True):
        groups.append([c, r, w])
        while len(groups) > 1 and groups[-1][1] < groups[-2][1]:
            c2, r2, w2 = groups.pop()
            c1, r1, w1 = groups.pop()
            groups.append([(c1 * w1 + c2 * w2) / (w1 + w2), (r1 * w1 + r2 * w2) / (w1 + w2), w1 + w2])
    return np.array([[g[0] for g in groups], [g[1] for g in groups]])


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """(key, keep..., score, n_neighbours, nearest_cosine, toxic_neighbours) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kept = [docs.schema[c] for c in (key, *keep)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score DOUBLE, n_neighbours INT, nearest_cosine DOUBLE, toxic_neighbours INT"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            n = batch.num_rows
            raw, near = np.full(n, own.rate), np.zeros(n)
            found, bad = np.zeros((2, n), np.int32)
            for first, data, bounds in arrays.chunks(batch.column(batch.num_columns - 1)):
                of, term, count = count_terms(data, bounds, own.vocabulary)
                names, begin = np.unique(of, return_index=True)
                for k, a, b in zip(names.tolist(), begin, np.append(begin, of.size)[1:], strict=True):
                    example, cosine = own.nearest(term[a:b], count[a:b])
                    if example.size:
                        at = first + k
                        raw[at], near[at] = own.vote(example, cosine), cosine[0]
                        found[at], bad[at] = example.size, own.label[example].sum()
            out = np.where(found > 0, own.calibrated(raw), own.rate)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns += [pa.array(np.clip(out, 0, 1)), pa.array(found), pa.array(np.minimum(near, 1.0)), pa.array(bad)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ["score", "n_neighbours", "nearest_cosine", "toxic_neighbours"])

    return docs.select(key, *keep, F.col(text).alias("_text")).mapInArrow(read, schema)

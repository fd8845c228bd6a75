"""Operator 8: language identification by interpolated Kneser-Ney character models.

A text is read as its words (runs of letters, lower-cased, with a mark before and after), a word
as its 4-grams of characters. The counts of all 4-grams in all training texts are summed by
language with Spark; a model of one language keeps, for every n-gram of order 1 to 4, its
interpolated probability in arrays sorted by the n-gram's 64-bit code, with the weight of each
history. No count is left out: beyond a counted size the models are tables instead of arrays, made with
Spark aggregates, and the distinct 4-grams of the texts are joined with them.
The language with the lowest cross-entropy a character wins. All training texts also give,
for each language, how far cross-entropy strays from its mean at a given length, and how high it is under the
nearest other language; a text beyond twice the 99.9th percentile of the first and most of the way to the second is rejected.

Null texts and texts without a letter are `und`, with score 0, and rejected. Empty training data
gives `und` for all. Ties go to the language that sorts first. Repeated rows and texts of any length are
scored alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays
from termweave.llm.store import stored

UNKNOWN = "und"
# 4-grams of all languages up to which (24 MB) the models are sent to every task; with more they stay tables and are joined.
SENT_GRAMS = 1_000_000
# 4-grams whose scores a task keeps.
CACHED_GRAMS = 400_000
ORDER = 4
# A 4-gram that is this share of the rows of a join or more is joined by broadcast: there are no more than 1 / HOT_SHARE.
HOT_SHARE = 0.001
# The part of the way from its own mean to that of the nearest other language beyond which a text is strange to a language.
STRANGE = 0.8
_EDGE, _FAR = 1, 0xFFFF
_tables: list[np.ndarray] = []


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower-case 16-bit code, is a letter) of every character."""
    if not _tables:
        lower = np.arange(0x110000, dtype=np.uint32)
        letter = np.zeros(0x110000, bool)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                letter[code] = True
                small = char.lower()
                if len(small) == 1:
                    lower[code] = ord(small)
        _tables.extend([np.minimum(lower, _FAR).astype(np.uint64), letter])
    return _tables[0], _tables[1]


@dataclass
class Words:
    """Distinct words of a run of texts: 4-gram codes, the word of each, and how often each text has each word."""

    grams: np.ndarray
    gram_word: np.ndarray
    text: np.ndarray
    word: np.ndarray
    count: np.ndarray
    n_words: int


def read_words(data: np.ndarray, bounds: np.ndarray) -> Words:
    lower, letter = _character_tables()
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    # Bounds in characters: bytes that do not continue a character, counted.
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = heads[bounds]
    small = lower[codes]
    starts, ends = arrays.runs(letter[codes], bounds)
    hashes = arrays.span_hashes(arrays.mix(small + np.uint64(7)), starts, ends)
    _, where, number = np.unique(hashes, return_index=True, return_inverse=True)
    text = np.searchsorted(bounds, starts, "right") - 1
    n = where.size
    pair, count = np.unique(text * max(n, 1) + number, return_counts=True)
    begin, size = starts[where], ends[where] - starts[where]
    # A word of k letters gives k + 1 grams: each letter and the end mark with the three symbols before.
    word = np.repeat(np.arange(n), size + 1)
    first = np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    step = np.arange(word.size) - first
    at, last = begin[word] + step, size[word]
    grams = np.zeros(word.size, np.uint64)
    padded = np.append(small, np.uint64(0))
    for back in (3, 2, 1, 0):
        k = step - back
        symbol = np.where(k < 0, np.where(k == -1, _EDGE, 0), np.where(k < last, padded[np.minimum(np.maximum(at - back, 0), small.size)], _EDGE))
        grams = (grams << np.uint64(16)) | symbol.astype(np.uint64)
    return Words(grams, word, pair // max(n, 1), pair % max(n, 1), count, n)


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all words of all texts that have a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("language_id")
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for first, data, bounds in arrays.chunks(batch.column(1)):
                words = read_words(data, bounds)
                here = langs[first : first + len(bounds) - 1]
                for name in set(here.tolist()):
                    own = (here == name)[words.text]
                    times = np.bincount(words.word[own], words.count[own], words.n_words)
                    weight = times[words.gram_word]
                    use = weight > 0
                    old = held.get(name, (np.empty(0, np.uint64), np.empty(0)))
                    grams, number = np.unique(np.concatenate([old[0], words.grams[use]]), return_inverse=True)
                    held[name] = grams, np.bincount(number, np.concatenate([old[1], weight[use]]), grams.size)
        for name, (grams, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * grams.size, pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
            )

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string"), text)
    return known.mapInArrow(count, "lang STRING, gram LONG, n LONG").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Interpolated Kneser-Ney probabilities of one language in sorted arrays, one set per order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int = ORDER):
        by = np.argsort(grams)
        keys, counts = grams[by].astype(np.uint64), counts[by].astype(float)
        levels = [(keys, counts)]
        for n in range(order - 1, 0, -1):
            # The continuation count of a shorter n-gram: distinct symbols seen before it.
            short, n_before = np.unique(levels[0][0] & np.uint64((1 << (16 * n)) - 1), return_counts=True)
            levels.insert(0, (short, n_before.astype(float)))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.floor = np.log(1.0 / (levels[0][0].size + 1))
        for n, (key, count) in enumerate(levels, 1):
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            history, which = np.unique(key >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(which, count), np.bincount(which)
            weight = discount * kinds / total
            lower = np.exp(self.score(key & np.uint64((1 << (16 * (n - 1))) - 1), n - 1)) if n > 1 else np.full(key.size, np.exp(self.floor))
            prob = np.maximum(count - discount, 0) / total[which] + weight[which] * lower
            self.levels.append((key, np.log(prob), history, np.log(weight)))

    def score(self, grams: np.ndarray, order: int | None = None) -> np.ndarray:
        """Log probability of the last symbol of each n-gram after the others."""
        order = len(self.levels) if order is None else order
        if order == 0:
            return np.full(grams.size, self.floor)
        key, prob, history, weight = self.levels[order - 1]
        at = np.minimum(np.searchsorted(key, grams), key.size - 1)
        out = prob[at]
        miss = np.flatnonzero(key[at] != grams)
        if miss.size:
            rest = grams[miss]
            below = self.score(rest & np.uint64((1 << (16 * (order - 1))) - 1), order - 1)
            past = rest >> np.uint64(16)
            at = np.minimum(np.searchsorted(history, past), history.size - 1)
            out[miss] = below + np.where(history[at] == past, weight[at], 0.0)
        return out


class Scorer:
    """Cross-entropy of texts under all models; scores of 4-grams seen before are looked up."""

    def __init__(self, models: list[Model]):
        self.models = models
        self.clear()

    def clear(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.scores = np.empty((0, len(self.models)))

    def gram_scores(self, grams: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, grams)
        seen = self.known[np.minimum(at, self.known.size - 1)] == grams if self.known.size else np.zeros(grams.size, bool)
        if not seen.all():
            if self.known.size > CACHED_GRAMS:
                self.clear()
                seen[:] = False
            new = grams[~seen]
            rows = np.stack([m.score(new) for m in self.models], 1)
            keys = np.concatenate([self.known, new])
            by = np.argsort(keys, kind="stable")
            self.known, self.scores = keys[by], np.concatenate([self.scores, rows])[by]
            at = np.searchsorted(self.known, grams)
        return self.scores[at]

    def entropies(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(cross-entropy by text and model, number of symbols) of runs of texts."""
        for _, data, bounds in arrays.chunks(texts):
            n = len(bounds) - 1
            words = read_words(data, bounds) if data.size else Words(*[np.empty(0, np.int64)] * 5, 0)
            size = np.bincount(words.text, words.count * np.bincount(words.gram_word, minlength=words.n_words)[words.word], n)
            out = np.zeros((n, len(self.models)))
            if words.grams.size and self.models:
                grams, number = np.unique(words.grams, return_inverse=True)
                scores = self.gram_scores(grams)
                for k in range(len(self.models)):
                    by_word = np.bincount(words.gram_word, scores[number, k], words.n_words)
                    out[:, k] = -np.bincount(words.text, words.count * by_word[words.word], n)
            yield out / np.maximum(size, 1)[:, None], size


@dataclass
class LanguageModels:
    """`models` in arrays, or None if they are `tables` of (lang, key, prob), (lang, history, weight) and floors."""

    names: list[str]
    models: list[Model] | None
    mean: np.ndarray
    limit: np.ndarray
    strange: np.ndarray
    floors: np.ndarray
    tables: list[tuple[DataFrame, DataFrame]] | None = None

    def rejects(self, best: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the lowest cross-entropy is too high for the winner: beyond chance, and nearer to a strange language than to it."""
        return low - self.mean[best] > np.maximum(self.limit[best] / np.sqrt(np.maximum(size, 1)), self.strange[best])

    def sent(self) -> LanguageModels:
        """What tasks need."""
        return replace(self, tables=None)


def _low(key: str, n: int):
    """The last n symbols of a code."""
    return F.col(key).bitwiseAND(F.lit((1 << (16 * n)) - 1)) if n < ORDER else F.col(key)


def _past(key: str):
    return F.shiftrightunsigned(key, 16)


def model_tables(counts: DataFrame) -> tuple[np.ndarray, list[tuple[DataFrame, DataFrame]]]:
    """The floor of each language in the order of names, and by order (lang, key, prob) and (lang, history, weight) in logarithms; as `Model` has them."""
    levels = [counts.select("lang", F.col("gram").alias("key"), F.col("n").cast("double").alias("n"))]
    for n in range(ORDER - 1, 0, -1):
        shorter = levels[0].groupBy("lang", _low("key", n).alias("key")).agg(F.count(F.lit(1)).cast("double").alias("n"))
        levels.insert(0, stored(shorter, "level"))
    sizes = levels[0].groupBy("lang").count().orderBy("lang").collect()
    floors = -np.log([r["count"] + 1.0 for r in sizes])
    floor = counts.sparkSession.createDataFrame([(r["lang"], float(x)) for r, x in zip(sizes, floors, strict=True)], "lang STRING, floor DOUBLE")
    tables: list[tuple[DataFrame, DataFrame]] = []
    for n, level in enumerate(levels, 1):
        once, twice = F.sum((F.col("n") == 1).cast("double")), F.sum((F.col("n") == 2).cast("double"))
        rates = level.groupBy("lang").agg(F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5).alias("discount"))
        totals = level.groupBy("lang", _past("key").alias("history")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        totals = totals.join(F.broadcast(rates), "lang").withColumn("weight", F.col("discount") * F.col("kinds") / F.col("total"))
        totals = stored(totals, "histories")
        every = level.withColumn("history", _past("key")).join(totals, ["lang", "history"])
        if n == 1:
            every = every.join(F.broadcast(floor), "lang").withColumn("lower", F.col("floor"))
        else:
            below = tables[-1][0].select("lang", F.col("key").alias("short"), F.col("prob").alias("lower"))
            every = every.withColumn("short", _low("key", n - 1)).join(below, ["lang", "short"])
        prob = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.exp("lower")
        tables.append((stored(every.select("lang", "key", F.log(prob).alias("prob")), "probabilities"), totals.select("lang", "history", F.log("weight").alias("weight"))))
    return floors, tables


def joined_scores(grams: DataFrame, models: LanguageModels) -> DataFrame:
    """(gram, s0, s1, ...): log probability of each of the distinct `grams` under the model of each name."""
    spark = grams.sparkSession
    floor = spark.createDataFrame([(name, float(x)) for name, x in zip(models.names, models.floors, strict=True)], "lang STRING, lower DOUBLE")
    scores = None
    for n, (probs, weights) in enumerate(models.tables, 1):
        asked = grams.select(_low("gram", n).alias("key")).distinct().crossJoin(F.broadcast(floor.select("lang") if n > 1 else floor))
        if n > 1:
            below = scores.select("lang", F.col("key").alias("short"), F.col("score").alias("lower"))
            asked = asked.withColumn("short", _low("key", n - 1)).join(below, ["lang", "short"])
        found = asked.withColumn("history", _past("key")).join(probs, ["lang", "key"], "left").join(weights, ["lang", "history"], "left")
        scores = stored(found.select("lang", "key", F.coalesce("prob", F.coalesce("weight", F.lit(0.0)) + F.col("lower")).alias("score")), "scores")
    return scores.groupBy(F.col("key").alias("gram")).agg(*(F.max(F.when(F.col("lang") == name, F.col("score"))).alias(f"s{k}") for k, name in enumerate(models.names)))


def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(one, two, gram, n) of every text of (one, two, text)."""
    for batch in batches:
        for first, data, bounds in arrays.chunks(batch.column(2)):
            if not data.size:
                continue
            words = read_words(data, bounds)
            # The grams of a word lie together, in the order of words.
            sizes = np.bincount(words.gram_word, minlength=words.n_words)
            begins = np.cumsum(sizes) - sizes
            many = sizes[words.word]
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begins[words.word], many)
            text, n = np.repeat(words.text, many), np.repeat(words.count, many)
            distinct, number = np.unique(words.grams, return_inverse=True)
            pair, which = np.unique(text * max(distinct.size, 1) + number[at], return_inverse=True)
            of = pa.array(pair // max(distinct.size, 1) + first)
            gram = distinct[pair % max(distinct.size, 1)].view(np.int64)
            columns = [batch.column(0).take(of), batch.column(1).take(of), pa.array(gram), pa.array(np.bincount(which, n, pair.size).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["one", "two", "gram", "n"])


def joined_entropies(docs: DataFrame, text: str, models: LanguageModels) -> DataFrame:
    """(one, two, entropy ARRAY<DOUBLE>, size LONG) of every distinct text with a letter, named by two hashes."""
    named = docs.where(F.col(text).isNotNull()).select(*_name(text), text).dropDuplicates(["one", "two"])
    grams = stored(named.mapInArrow(_text_grams, "one LONG, two LONG, gram LONG, n LONG"), "grams")
    kinds = stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")), "kinds")
    total = kinds.agg(F.sum("rows")).first()[0] or 0
    scores = stored(joined_scores(kinds.select("gram"), models), "gram_scores")
    # Grams of very many texts go to the texts, so that no task holds all rows of one.
    hot = F.broadcast(kinds.where(F.col("rows") >= HOT_SHARE * total).select("gram"))
    common = grams.join(F.broadcast(scores.join(hot, "gram", "left_semi")), "gram")
    both = common.unionByName(grams.join(hot, "gram", "left_anti").join(scores, "gram"))
    size = F.sum("n")
    sums = F.array(*(-F.sum(F.col("n") * F.col(f"s{k}")) / size for k in range(len(models.names))))
    return stored(both.groupBy("one", "two").agg(sums.alias("entropy"), size.alias("size")), "entropies")


def _name(text: str) -> list:
    return [F.xxhash64(text).alias("one"), F.xxhash64(F.lit(1), text).alias("two")]


def _score_rows(docs: DataFrame, columns: list[str], text: str, models: LanguageModels, schema: str, emit) -> DataFrame:
    """emit(columns, entropy by model, number of symbols, models) of every row, in arrays or by joins; the results are those of `schema`."""
    shared = docs.sparkSession.sparkContext.broadcast(models.sent())
    if models.tables is not None:
        found = joined_entropies(docs, text, models).withColumnsRenamed({c: f"_{c}" for c in ("one", "two", "entropy", "size")})
        one, two = _name(text)
        rows = docs.select(*columns, one.alias("_h1"), two.alias("_h2"))
        rows = rows.join(found, (F.col("_h1") == F.col("_one")) & (F.col("_h2") == F.col("_two")), "left").select(*columns, "_entropy", "_size")

        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in filter(len, batches):
                lists, size = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
                entropy = np.zeros((batch.num_rows, len(own.names)))
                known = lists.is_valid().to_numpy(zero_copy_only=False)
                entropy[known] = lists.flatten().to_numpy().reshape(-1, len(own.names))
                yield emit(batch.select(range(batch.num_columns - 2)), entropy, size.fill_null(0).to_numpy(), own)

        return rows.mapInArrow(take, schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays.make_room("language_id")
        own = shared.value
        scorer = Scorer(own.models)
        for batch in filter(len, batches):
            parts = list(scorer.entropies(batch.column(batch.num_columns - 1)))
            yield emit(batch.select(range(batch.num_columns - 1)), np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), own)

    return docs.select(*columns, F.col(text).alias("_text")).mapInArrow(score, schema)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModels:
    """Models of every language in `docs`, with the limits of rejection; counts and limits cover all texts."""
    counts = stored(count_grams(docs, text, lang), "counts")
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    n = len(names)
    out = LanguageModels(names, [], np.zeros(n), np.full(n, np.inf), np.zeros(n), np.zeros(n))
    if not names:
        return out
    if counts.count() <= SENT_GRAMS:
        rows = counts.toPandas()
        for name in names:
            own = rows[rows["lang"] == name]
            out.models.append(Model(own["gram"].to_numpy(np.int64).view(np.uint64), own["n"].to_numpy()))
        out.floors = np.array([m.floor for m in out.models])
    else:
        out.models = None
        out.floors, out.tables = model_tables(counts)

    def emit(batch: pa.RecordBatch, entropy: np.ndarray, size: np.ndarray, models: LanguageModels) -> pa.RecordBatch:
        at = np.array([models.names.index(x) if x in models.names else 0 for x in batch.column(0).to_pylist()], np.int64)
        own = entropy[np.arange(len(at)), at]
        others = np.where(np.arange(entropy.shape[1]) == at[:, None], np.inf, entropy).min(1)
        others = np.where(np.isfinite(others), others, -models.floors[0] * 2)
        columns = [pa.array(at), pa.array(own), pa.array(others), pa.array(size.astype(float))]
        return pa.RecordBatch.from_arrays(columns, ["lang", "entropy", "other", "size"])

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    found = stored(_score_rows(known, ["lang"], "text", out, "lang LONG, entropy DOUBLE, other DOUBLE, size DOUBLE", emit).where("size > 0"), "trained")
    weighted = [(F.sum(F.col(c) * F.col("size")) / F.sum("size")).alias(c) for c in ("entropy", "other")]
    means = found.groupBy("lang").agg(*weighted).collect()
    for row in means:
        out.mean[row["lang"]] = row["entropy"]
        out.strange[row["lang"]] = STRANGE * max(row["other"] - row["entropy"], 0.0)
    mean = F.element_at(F.array(*(F.lit(float(x)) for x in out.mean)), (F.col("lang") + 1).cast("int"))
    strayed = (F.col("entropy") - mean) * F.sqrt("size")
    for row in found.groupBy("lang").agg(F.percentile_approx(strayed, 0.999, 100_000).alias("far")).collect():
        out.limit[row["lang"]] = 2 * max(row["far"], 1.0)
    return out


def identify(docs: DataFrame, models: LanguageModels, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """(key, keep..., lang_pred, score, cross_entropy, rejected) of every row.

    `score` is the winner's share if each language is weighted by exp(-cross-entropy * symbols),
    with 32 symbols counted at most so that it tells long texts apart too.
    """
    fields = [docs.schema[c] for c in (key, *keep)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred STRING, score DOUBLE, cross_entropy DOUBLE, rejected BOOLEAN"

    def emit(batch: pa.RecordBatch, entropy: np.ndarray, size: np.ndarray, models: LanguageModels) -> pa.RecordBatch:
        n = len(size)
        if models.names:
            best = entropy.argmin(1)
            low = entropy[np.arange(n), best]
            score = 1 / np.exp((low[:, None] - entropy) * np.minimum(size, 32)[:, None]).sum(1)
            reject = models.rejects(best, low, size)
            names = np.array(models.names, object)[best]
        else:
            low, score, reject, names = np.zeros(n), np.zeros(n), np.ones(n, bool), np.full(n, UNKNOWN, object)
        empty = size == 0
        names[empty], score[empty], reject[empty] = UNKNOWN, 0.0, True
        columns = list(batch.columns)
        columns += [pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(low), pa.array(reject)]
        return pa.RecordBatch.from_arrays(columns, [f.name for f in fields] + ["lang_pred", "score", "cross_entropy", "rejected"])

    return _score_rows(docs, [key, *keep], text, models, schema, emit)


def known_only(docs: DataFrame, models: LanguageModels, text: str = "text") -> DataFrame:
    """The rows of `docs` that no rejection takes, as they are."""

    def emit(batch: pa.RecordBatch, entropy: np.ndarray, size: np.ndarray, models: LanguageModels) -> pa.RecordBatch:
        if not models.names:
            return batch.slice(0, 0)
        best = entropy.argmin(1)
        low = entropy[np.arange(size.size), best]
        return batch.filter(pa.array((size > 0) & ~models.rejects(best, low, size)))

    return _score_rows(docs, docs.columns, text, models, docs.schema, emit)

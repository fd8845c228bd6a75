"""Ranking many queries at once over postings (term, doc_id, tf, doc_len)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.functions.scoring import (
    DF_EPSILON,
    bm25_idf,
    bm25_weight,
    col,
    log10_idf,
    ratio,
    rounded,
)
from termweave.operators.index import count_terms
from termweave.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, join_by_term, plan_bytes

Scalar = Column | float | int
# The bin of scores that have no logarithm, below all others.
NO_SCORE = -(1 << 40)
# The largest tf that is a bit of a number.
SMALL_TF = 62


def query_terms(
    queries: DataFrame,
    stops: Sequence[str] = (),
    pattern: str = text_fn.TOKEN_PATTERN,
    keys: Sequence[str] = ("query_id",),
) -> DataFrame:
    """queries(query_id, text) -> (query_id, term, qtf, query_len)."""
    counted = count_terms(queries, text_fn.tokens("text", stops, pattern), keys)
    return counted.withColumnsRenamed({"tf": "qtf", "doc_len": "query_len"})


def match(
    terms: DataFrame,
    postings: DataFrame,
    stats: DataFrame | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    on: Sequence[str] = ("term",),
    broadcast_bytes: int = BROADCAST_BYTES,
    parts: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(known, found): the query terms of the index with their df, and one row per known term and document with it.

    The query terms go to every task where the optimizer knows them to be small: to the term statistics, then (no
    more rows than before, since the statistics have one row per term) to the postings, which are not
    shuffled. Otherwise both joins shuffle. `enrich` adds columns to the known terms before they meet the postings.

    With `parts` the postings of known terms are dealt to that many tasks by document before they meet the queries, so what is
    shuffled has a row for a posting and not for each query with it, and sums by query and document need no shuffle.
    """
    fits = plan_bytes(terms) <= broadcast_bytes
    known = terms
    if stats is not None:
        known = join_by_term(stats.select("term", "df"), terms, fits)
    if enrich is not None:
        known = enrich(known)
    if parts is not None and fits:
        asked = F.broadcast(terms.select(*on).distinct())
        postings = postings.join(asked, list(on), "left_semi").repartition(parts, "doc_id")
    return known, join_by_term(postings, known, fits, on)


def top_n(run: DataFrame, n: int, by: Sequence[str] = ("query_id",)) -> DataFrame:
    """The n best documents of each query with their rank; equal scores by doc_id.

    Spark keeps the first n rows per query in every task before the shuffle, so a
    query with very many candidates moves only n rows per task.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return run.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_by(run: DataFrame, depths: DataFrame, fits: bool = False) -> DataFrame:
    """The `depth` best documents of each query with their rank, for depths(query_id, depth).

    A window with a column as its limit has no partial stage. So the scores of a query are counted in bins of
    about 2 percent, with partial sums; the bin in which the depth is reached bounds the
    scores from below, and only candidates from there on are shuffled and ordered. Where the depths `fit` a broadcast, so do
    these bounds, a row for a query, and the run meets them before it is shuffled.
    """
    bin_of = F.when(F.col("score") > 0, F.floor(F.ln("score") * 50.0)).otherwise(F.lit(NO_SCORE))
    binned = run.withColumn("bin", bin_of)
    sizes = binned.groupBy("query_id", "bin").agg(F.count(F.lit(1)).alias("n")).join(depths, "query_id")
    above = Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    open_ = sizes.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0))).where("above < depth")
    least = open_.groupBy("query_id").agg(F.min("bin").alias("least"), F.first("depth").alias("depth"))
    kept = binned.join(F.broadcast(least) if fits else least, "query_id").where("bin >= least")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return kept.withColumn("rank", F.row_number().over(best)).where("rank <= depth").drop("bin", "least", "depth")


def in_order(run: DataFrame) -> DataFrame:
    """All results, best first; the sort key ends in doc_id, so one large query spreads over tasks."""
    return run.orderBy("query_id", F.desc("score"), "doc_id")


def candidates(found: DataFrame) -> DataFrame:
    """Documents that have any term of the query."""
    return found.select("query_id", "doc_id").distinct()


def candidate_tfidf(found: DataFrame, n_docs: Scalar) -> DataFrame:
    """(query_id, doc_id, term, tfidf) with tf / doc_len * log10(N / df)."""
    weight = F.col("tf") / F.col("doc_len") * log10_idf(n_docs)
    return found.select("query_id", "doc_id", "term", weight.alias("tfidf"))


def query_tfidf(known: DataFrame, n_docs: Scalar) -> DataFrame:
    """(query_id, term, tfidf) with qtf / query_len * log10(N / (df + 1e-7))."""
    weight = F.col("qtf") / F.col("query_len") * log10_idf(n_docs, "df", DF_EPSILON)
    return known.select("query_id", "term", weight.alias("tfidf"))


def _query_norms(weights: DataFrame, name: str = "tfidf") -> DataFrame:
    return weights.groupBy("query_id").agg(F.sqrt(F.sum(F.col(name) * F.col(name))).alias("q_norm"))


def with_query_norm(known: DataFrame, n_docs: Scalar) -> DataFrame:
    """Known query terms with their cosine weight and the norm of their query: a window over the few terms of a query."""
    weight = F.col("qtf") / F.col("query_len") * log10_idf(n_docs, "df", DF_EPSILON)
    norm = F.sqrt(F.sum(F.col("q") * F.col("q")).over(Window.partitionBy("query_id")))
    return known.withColumn("q", weight).withColumn("q_norm", norm)


def cosine(found: DataFrame, n_docs: Scalar) -> DataFrame:
    """Cosine of query and document over the query terms, 5 digits, for terms matched `with_query_norm`.

    The norm comes with the terms, so the one shuffle is that of the sums.
    """
    d = F.col("tf") / F.col("doc_len") * log10_idf(n_docs)
    sums = found.select("query_id", "doc_id", d.alias("d"), "q", "q_norm").groupBy("query_id", "doc_id").agg(
        F.sum(F.col("d") * F.col("q")).alias("dot"), F.sqrt(F.sum(F.col("d") * F.col("d"))).alias("d_norm"), F.first("q_norm").alias("q_norm")
    )
    return sums.select("query_id", "doc_id", rounded(ratio("dot", F.col("d_norm") * F.col("q_norm")), 5).alias("score"))


def tfidf_vectors(postings: DataFrame, stats: DataFrame, n_docs: Scalar) -> DataFrame:
    """(doc_id, term, weight): tf * (ln((1 + n) / (1 + df)) + 1), each document of length 1.

    The join on term and the window over a document's own terms are the only shuffles;
    adaptive execution cuts the partitions of very frequent terms in the join.
    """
    idf = F.ln((1.0 + col(n_docs)) / (1.0 + F.col("df"))) + 1.0
    raw = postings.join(stats.select("term", "df"), "term").select(
        "doc_id", "term", (F.col("tf") * idf).alias("raw")
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("raw") / norm).alias("weight"))


def query_vectors(known: DataFrame, n_docs: Scalar) -> DataFrame:
    """The same weights for queries, over terms of the corpus."""
    idf = F.ln((1.0 + col(n_docs)) / (1.0 + F.col("df"))) + 1.0
    raw = known.select("query_id", "term", (F.col("qtf") * idf).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("query_id")))
    return raw.select("query_id", "term", (F.col("raw") / norm).alias("q_weight"))


def cosine_of_postings(postings: DataFrame, stats: DataFrame, n_docs: Scalar, queries: DataFrame, fits: bool = False) -> DataFrame:
    """The cosine matrix without the vectors of all documents.

    Postings of query terms alone are summed by pair; the length of a document is a sum
    over its postings, combined before the shuffle.
    """
    idf = F.ln((1.0 + col(n_docs)) / (1.0 + F.col("df"))) + 1.0
    raw = postings.join(stats.select("term", "df"), "term").select("doc_id", "term", (F.col("tf") * idf).alias("raw"))
    norms = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    weighed = queries.join(stats.select("term", "df"), "term").withColumn("both", F.col("q_weight") * idf)
    shared = join_by_term(postings, weighed.select("query_id", "term", "both"), fits)
    sums = shared.groupBy("query_id", "doc_id").agg(F.sum(F.col("tf") * F.col("both")).alias("dot"))
    return sums.join(norms, "doc_id").select("query_id", "doc_id", rounded(F.col("dot") / F.col("norm"), 5).alias("score"))


def cosine_matrix(vectors: DataFrame, queries: DataFrame, fits: bool = False) -> DataFrame:
    """(query_id, doc_id, score) of all pairs that share a term; other pairs are 0 and not written."""
    shared = join_by_term(vectors, queries, fits)
    return shared.groupBy("query_id", "doc_id").agg(
        rounded(F.sum(F.col("weight") * F.col("q_weight")), 5).alias("score")
    )


def _bm25(found: DataFrame, by: Sequence[str], weight: Column) -> DataFrame:
    return found.groupBy(*by, "doc_id").agg(rounded(F.sum(weight), 5).alias("score"))


def _bm25_term(tf: Column, n_docs: Scalar, avg_len: Scalar, k1: Column, b: Column) -> Column:
    return F.col("qtf") * bm25_idf(n_docs) * bm25_weight(tf, F.col("doc_len"), avg_len, k1, b)


def bm25(found: DataFrame, n_docs: Scalar, avg_len: Scalar, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """BM25 over candidates; every occurrence of a query term adds once."""
    weight = _bm25_term(F.col("tf"), n_docs, avg_len, F.lit(k1), F.lit(b))
    return _bm25(found, ["query_id"], weight)


def bm25_grid(
    found: DataFrame, n_docs: Scalar, avg_len: Scalar, settings: Sequence[tuple[float, float]]
) -> DataFrame:
    """(k1, b, query_id, doc_id, score) for all settings from one join of queries and postings.

    A setting is a sum of its own in one aggregate, so what is shuffled has a row for a query and document, not for a setting.
    """
    sums = [_bm25_term(F.col("tf"), n_docs, avg_len, F.lit(float(k1)), F.lit(float(b))) for k1, b in settings]
    scores = found.groupBy("query_id", "doc_id").agg(*[rounded(F.sum(w), 5).alias(f"score_{i}") for i, w in enumerate(sums)])
    opened = [
        F.struct(F.lit(float(k1)).alias("k1"), F.lit(float(b)).alias("b"), F.col(f"score_{i}").alias("score"))
        for i, (k1, b) in enumerate(settings)
    ]
    return scores.select("query_id", "doc_id", F.inline(F.array(*opened))).select("k1", "b", "query_id", "doc_id", "score")


def bm25_naive(found: DataFrame, n_docs: Scalar, avg_len: Scalar, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """BM25 with length-normalised tf; a query term weighs its count squared.

    Documents without a query term score 0 and are not written.
    """
    norm_tf = F.col("tf") / F.col("doc_len")
    weight = F.col("qtf") * _bm25_term(norm_tf, n_docs, avg_len, F.lit(k1), F.lit(b))
    return _bm25(found, ["query_id"], weight)


def served_score(found: DataFrame, n_docs: Scalar) -> DataFrame:
    """The body score: sum of qtf^2 * log10(N / df)^2 * tf, over N^2 * query_len.

    The divisor is one number per query; results are ordered by the sum, 5 digits.
    """
    n = col(n_docs)
    sums = found.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("qtf") * F.col("qtf") * log10_idf(n) * log10_idf(n) * F.col("tf")).alias("total"),
        F.first("query_len").alias("query_len"),
    )
    return sums.select(
        "query_id", "doc_id", (rounded("total", 5) / (n * n * F.col("query_len"))).alias("score")
    )


def subset_score(known: DataFrame, found: DataFrame, fits: bool = False) -> DataFrame:
    """Cosine with document weight tf * df; N is the number of distinct (doc_id, tf) of the query's postings.

    Query weights are qtf / query_len * log10(N / (df + 1e-7)). N is one number per
    query, so log10(N) is left out of the sums over postings and put in afterwards:
    dot = log10(N) * sum(d * share) - sum(d * share * log10(df + 1e-7)). Where the query terms `fit` a broadcast the norms do.
    """
    # The small tf of a document are bits of one number, so a document is one row; the others, which are rare, are counted as rows.
    keyed = found.where("doc_id IS NOT NULL AND tf IS NOT NULL")
    bits = keyed.where(f"tf BETWEEN 0 AND {SMALL_TF}").groupBy("query_id", "doc_id").agg(F.bit_or(F.expr("shiftleft(1L, CAST(tf AS INT))")).alias("bits"))
    small = bits.select("query_id", F.bit_count("bits").cast("long").alias("n"))
    large = keyed.where(f"NOT tf BETWEEN 0 AND {SMALL_TF}").select("query_id", "doc_id", "tf").distinct().select("query_id", F.lit(1).cast("long").alias("n"))
    none = known.select("query_id", F.lit(0).cast("long").alias("n"))
    subset = small.unionByName(large).unionByName(none).groupBy("query_id").agg(F.sum("n").alias("n_subset"))
    share = F.col("qtf") / F.col("query_len")
    log_df = F.log10(F.col("df") + F.lit(DF_EPSILON))
    weights = known.join(subset, "query_id").withColumn("q", share * log10_idf("n_subset", "df", DF_EPSILON))
    norms = _query_norms(weights, "q").join(subset, "query_id")
    d = (F.col("tf") * F.col("df")).cast("double")
    sums = found.groupBy("query_id", "doc_id").agg(
        F.sum(d * share).alias("plain"),
        F.sum(d * share * log_df).alias("logged"),
        F.sqrt(F.sum(d * d)).alias("d_norm"),
    )
    dot = F.log10("n_subset") * F.col("plain") - F.col("logged")
    return sums.join(F.broadcast(norms) if fits else norms, "query_id").select(
        "query_id", "doc_id", rounded(ratio(dot, F.col("d_norm") * F.col("q_norm")), 5).alias("score")
    )


def fast_cosine(found: DataFrame) -> DataFrame:
    """Occurrences of the query words over document length."""
    occurrences = F.sum(F.col("qtf") * F.col("tf"))
    return found.groupBy("query_id", "doc_id").agg((occurrences / F.first("doc_len")).alias("score"))


def match_count(found: DataFrame) -> DataFrame:
    """Title and anchor score: occurrences of query words (score) and number of matched words (n_matched)."""
    return found.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("qtf") * F.col("tf")).alias("score"), F.count(F.lit(1)).alias("n_matched")
    )


def attach_titles(run: DataFrame, titles: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Results with titles(doc_id, title); results without a title are left out.

    `max_rows` is a known bound on the run, such as n times the number of queries of a
    top-n run. Within the broadcast limit the run goes to the titles, which then are not
    shuffled.
    """
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return titles.join(F.broadcast(run), "doc_id")
    return run.join(titles, "doc_id")

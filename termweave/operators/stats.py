"""Corpus statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions.text import reaches_min_length
from termweave.functions.stem import stem
from termweave.operators.index import term_stats
from termweave.operators.joins import dealt_parts

# Bytes of one posting in the size report.
POSTING_BYTES = 6
# Longest run of ranks that one task writes out.
RANKS_PER_ROW = 1 << 16


def count_words(*postings: DataFrame) -> DataFrame:
    """(term, n) over all given fields."""
    rows = reduce(DataFrame.unionByName, [part.select("term", "tf") for part in postings])
    return rows.groupBy("term").agg(F.sum("tf").alias("n"))


def content_words(stats: DataFrame, stops: Sequence[str]) -> DataFrame:
    """Words of three characters and more that are not stop words."""
    return stats.where((F.length("term") > 2) & ~F.col("term").isin(list(stops)))


def top_terms(stats: DataFrame, by: str, n: int, group: str = "field") -> DataFrame:
    """(group, rank, term, value): the n highest terms of each group."""
    order = Window.partitionBy(group).orderBy(F.desc(by), "term")
    return (
        stats.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select(group, "rank", "term", F.col(by).alias("value"))
    )


def corpus_stopwords(stats: DataFrame, n_docs, min_share: float, stops: Sequence[str]) -> DataFrame:
    """Content words found in at least `min_share` of the documents."""
    share = F.col("df") / n_docs
    return content_words(stats, stops).where(share >= min_share).select("term", "df")


def rare_words(stats: DataFrame, max_total: int = 2) -> DataFrame:
    """Words with at most `max_total` occurrences."""
    return stats.where(F.col("term_total") <= max_total).select("term", "term_total")


def frequency_classes(stats: DataFrame) -> DataFrame:
    """(frequency, n_terms): how many terms occur that often."""
    return stats.groupBy(F.col("term_total").alias("frequency")).agg(F.count(F.lit(1)).alias("n_terms"))


def zipf(stats: DataFrame) -> DataFrame:
    """(rank, frequency, log_rank, log_frequency), frequencies descending, ranks 1, 2, 3, ...

    Terms of one frequency take consecutive ranks, so the ranks follow from the
    frequency classes and no task sorts the vocabulary. The window over the classes is
    small: frequencies add up to the corpus size T, so there are at most sqrt(2 T).
    """
    earlier = Window.orderBy(F.desc("frequency")).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_terms").over(earlier), F.lit(0))
    pieces = (
        frequency_classes(stats)
        .withColumn("before", first)
        .select(
            "frequency",
            (F.col("before") + F.col("n_terms")).alias("last"),
            F.explode(
                F.sequence(F.col("before") + 1, F.col("before") + F.col("n_terms"), F.lit(RANKS_PER_ROW))
            ).alias("start"),
        )
        .repartition("start")
    )
    ranks = F.sequence("start", F.least(F.col("start") + RANKS_PER_ROW - 1, "last"))
    return pieces.select(F.explode(ranks).alias("rank"), "frequency").select(
        "rank", "frequency", F.ln("rank").alias("log_rank"), F.ln("frequency").alias("log_frequency")
    )


def zipf_slope(ranks: DataFrame) -> DataFrame:
    """(slope, n_ranks) of the log-log line."""
    return ranks.agg(
        F.regr_slope("log_frequency", "log_rank").alias("slope"), F.count(F.lit(1)).alias("n_ranks")
    )


def variant_terms(stats: DataFrame, stops: Sequence[str], max_rare: int = 2) -> DataFrame:
    """(variant, term, df, term_total): which terms each index variant keeps.

    `stats` counts the tokens of the short pattern; the variants without stop words
    start from the 3-character tokens among them, so one pass over the text serves all.
    """
    kept = reaches_min_length("term") & ~F.col("term").isin(list(stops))
    frequent = kept & (F.col("term_total") > max_rare)
    variants = F.array_compact(
        F.array(
            F.lit("all_words"),
            F.when(kept, F.lit("stop_removed")),
            F.when(frequent, F.lit("stop_rare_removed")),
        )
    )
    return stats.select(F.explode(variants).alias("variant"), "term", "df", "term_total")


def index_variants(stats: DataFrame, stops: Sequence[str], max_rare: int = 2) -> DataFrame:
    """(variant, n_terms, n_postings, n_tokens)."""
    return (
        variant_terms(stats, stops, max_rare)
        .groupBy("variant")
        .agg(
            F.count(F.lit(1)).alias("n_terms"),
            F.sum("df").alias("n_postings"),
            F.sum("term_total").alias("n_tokens"),
        )
    )


def stem_vocabulary(stats: DataFrame) -> DataFrame:
    """(term, stem): every distinct term stemmed once."""
    return stats.select("term").withColumn("stem", stem("term"))


def stem_postings(postings: DataFrame, stems: DataFrame) -> DataFrame:
    """Postings by stem: (term, doc_id, tf), where `term` is the stem.

    Few postings of a document share a stem, so sums before a shuffle would hold nearly all rows of a task. The rows go to small parts
    by document, and are summed there.
    """
    stemmed = postings.join(stems, "term").select(F.col("stem").alias("term"), "doc_id", "tf")
    by_document = stemmed.repartition(dealt_parts(postings), "doc_id")
    return by_document.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf"))


def stemmed_variant(postings: DataFrame, stats: DataFrame, stops: Sequence[str], max_rare: int = 2) -> DataFrame:
    """The variant row of the index with stop and rare words removed and the rest stemmed."""
    kept = variant_terms(stats, stops, max_rare).where("variant = 'stop_rare_removed'")
    stemmed = term_stats(stem_postings(postings, stem_vocabulary(kept)))
    return stemmed.agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.sum("df").alias("n_postings"),
        F.sum("term_total").alias("n_tokens"),
    ).select(F.lit("with_stemming").alias("variant"), "n_terms", "n_postings", "n_tokens")


def index_size(variants: DataFrame) -> DataFrame:
    """(variant, size_mb), largest first."""
    return variants.select(
        "variant", (F.col("n_postings") * POSTING_BYTES / F.lit(1e6)).alias("size_mb")
    ).orderBy(F.desc("size_mb"))

"""The registered queries of the operators, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm import (
    decontaminate,
    language_id,
    packing,
    periodic_runs,
    pii,
    prefix_trees,
    preference,
    repeats,
    set_join,
    spelling,
    toxicity,
    url_lists,
    vector_index,
)
from termweave.llm.queries_sql import SQL
from termweave.llm.store import short_batches, stored
from termweave.operators import index

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function's name."""
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def fold(folds: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(F.col(key).cast("string")) % folds


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles overlap by 90 in 100 or more."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = set_join.jaccard_components(docs, n=3, num=90, den=100)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query
def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans by pattern, further ones by the random field."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return pii.digest_columns(pii.find_spans(docs, pii.fit(docs)))


@query
def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen, against one whose later turns are those of the conversation after it.

    Conversations share the turns before the fork and whatever follows that is equal.
    """
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    chosen = turns.withColumnRenamed("conv_id", "pair_id")
    forks_at = 1 + F.col("pair_id") % 3
    head = chosen.where(F.col("turn") < forks_at)
    tail = turns.withColumn("pair_id", F.col("conv_id") - 1).drop("conv_id").where((F.col("pair_id") >= 0) & (F.col("turn") >= forks_at))
    out = preference.preference_pairs(chosen, head.unionByName(tail))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string"))), ",")
    return out.withColumn("mask", spans)


@query
def op4_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples; labels of held-out rows are not read."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").where(fold(5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_neighbours", "toxic_neighbours", "nearest_cosine"
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces packed into sequences of 1,024 tokens."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that start twice in the corpus."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = repeats.remove_repeats(docs)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that align with a benchmark item."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by models of the documents that are not held out."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    models = language_id.fit(docs.where(fold(4) != 2))
    found = language_id.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def dated_lists(pages: DataFrame, events: DataFrame) -> DataFrame:
    """Entries (list, pattern, action, at): events of a user add hosts of pages to lists, or take them off.

    Hosts are numbered by name, and an event is for the host that its user's number leads to. Views put it on
    the block list, clicks on the allow list, and all else removes it from either.
    """
    hosts = pages.select(url_lists.host_of("url").alias("pattern")).where("pattern IS NOT NULL").distinct()
    hosts = index.number_rows(hosts, "pattern").withColumn("slot", F.col("row_number") - 1)
    n = hosts.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    dated = events.select(F.pmod(F.coalesce("user_id", F.lit(0)) * 7_919, n).alias("slot"), "event_type", F.col("ts").alias("at"), "event_id")
    listed = dated.join(hosts, "slot")
    on = F.when(F.col("event_type") == "view", "block").when(F.col("event_type") == "click", "allow")
    both = F.when(on.isNotNull(), F.array(on)).otherwise(F.array(F.lit("block"), F.lit("allow")))
    return listed.select(F.explode(both).alias("list"), "pattern", F.when(on.isNotNull(), "add").otherwise("remove").alias("action"), "at")


@query
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the lists as they stood when it was fetched, some minute of the 27 days from the first event on."""
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    events = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    began = events.agg(F.min("ts").alias("began")).select("began").scalar()
    captures = pages.withColumn("fetched_at", began + F.make_dt_interval(mins=(F.col("page_id") * 7_919 % 40_000).cast("int")))
    found = url_lists.filter_captures(captures, dated_lists(pages, events))
    return found.withColumn("lists", F.array_join("lists", ","))


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings with a cosine of 0.9 or more."""
    found = vector_index.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def with_periods(docs: DataFrame) -> DataFrame:
    """`docs` with a repeated tail in every tenth text: from word a on, its next p words again and again."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"))
    n = F.size("_words").cast("long")
    a = g % n
    p = 1 + F.floor((n - F.col("_a")) / (3 + g % 8))
    turned = F.transform("_words", lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    chosen = (h % 10 == 0) & F.col("text").isNotNull()
    turn = docs.withColumn("_words", F.when(chosen, words)).withColumn("_a", F.when(n > 0, a)).withColumn("_p", p)
    return turn.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, every tenth with a repeated tail, and what is left without repeats."""
    found = periodic_runs.find_runs(with_periods(read(spark, sf_dir, "documents", "doc_id", "text")))
    found = found.withColumn("top", periodic_runs.strongest())
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, with slips, that occur twice, and the more frequent word that each is a variant of."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    words = stored(spelling.count_words(docs, slip=31).where("n >= 2"), "words")
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 13 words that start in an earlier one."""
    found = prefix_trees.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

"""Inverted indexes as postings in long form: one row (term, doc_id, tf, doc_len) per term of a document."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.operators.joins import dealt_parts
from termweave.session import shared_dir

# Documents per block of a posting list. With integer ids a block holds at most this many postings.
BLOCK_DOCS = 1 << 16


def count_terms(docs: DataFrame, tokens: Column, keys: Sequence[str] = ("doc_id",), lengths: bool = False) -> DataFrame:
    """(keys, term, tf, doc_len) for every distinct token of a row; with `lengths` also a row without a term for every row.

    A document is one row, so its tokens are counted inside the row (sort, then read
    off the runs): nothing is shuffled. The arrays pass through explode(array(...)),
    which keeps the optimizer from pasting the tokenizer into the lambda. Before the ends of
    the runs stands -1, which is the row without a term; the ends become rows, and terms and
    counts are read off in generated code.
    """
    keys = list(keys)
    in_order = docs.select(*keys, F.explode(F.array(F.sort_array(tokens))).alias("words"))
    if not lengths:
        in_order = in_order.where("size(words) > 0")
    ends = (
        "array(concat(array(-1), filter(if(size(words) > 0, sequence(0, size(words) - 1), array()),"
        " i -> coalesce(get(words, i) <> get(words, i + 1), i = size(words) - 1))))"
    )
    runs = in_order.select(*keys, "words", F.explode(F.expr(ends)).alias("ends")).select(
        *keys, "words", "ends", F.size("words").cast("long").alias("doc_len"), F.posexplode("ends").alias("place", "last")
    )
    if not lengths:
        runs = runs.where("place > 0")
    return runs.select(
        *keys,
        F.expr("get(words, last)").alias("term"),
        F.expr("cast(if(place > 0, last - ends[place - 1], 0) as long)").alias("tf"),
        "doc_len",
    )


def max_tf(docs: DataFrame, tokens: Column) -> DataFrame:
    """(doc_id, max_tf) of documents with tokens: the longest run of equal ones in the sorted row."""
    runs = docs.select("doc_id", F.explode(F.array(F.sort_array(tokens))).alias("words")).where("size(words) > 0")
    ends = F.expr("array(filter(sequence(0, size(words) - 1), i -> i = size(words) - 1 or words[i] <> words[i + 1]))")
    longest = F.expr("array_max(transform(ends, (last, n) -> cast(last - if(n > 0, ends[n - 1], -1) as long)))")
    return runs.select("doc_id", F.explode(ends).alias("ends")).select("doc_id", longest.alias("max_tf"))


def build_postings(
    docs: DataFrame,
    text: str = "text",
    stops: Sequence[str] = (),
    pattern: str = text_fn.TOKEN_PATTERN,
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Postings of a text column."""
    return count_terms(docs, text_fn.tokens(text, stops, pattern), keys)


def anchor_postings(links: DataFrame, stops: Sequence[str] = (), pattern: str = text_fn.TOKEN_PATTERN) -> DataFrame:
    """Postings of all anchor text that points to a page: links(target_id, anchor_text).

    The texts of a target lie in many rows; they are counted per link first, so a page
    that a third of all links point to shuffles one row per term and task.
    """
    per_link = count_terms(links, text_fn.tokens("anchor_text", stops, pattern), ["target_id"])
    return per_link.groupBy(F.col("target_id").alias("doc_id"), "term").agg(F.sum("tf").alias("tf"))


def merge_postings(*parts: DataFrame) -> DataFrame:
    """One index from partial indexes; postings of the same term and document add up."""
    rows = reduce(DataFrame.unionByName, [part.select("term", "doc_id", "tf") for part in parts])
    return rows.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf"))


def add_documents(postings: DataFrame, docs: DataFrame, text: str = "text", stops: Sequence[str] = ()) -> DataFrame:
    """The index with more documents in it."""
    return merge_postings(postings, build_postings(docs, text, stops))


def term_stats(postings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """df and term_total per term."""
    return postings.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("term_total"))


def remove_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings without the terms of a table of any size."""
    return postings.join(terms, "term", "left_anti")


def drop_rare(stats: DataFrame, min_df: int) -> DataFrame:
    """Terms found in more than `min_df` documents."""
    return stats.where(F.col("df") > min_df)


def doc_stats(docs: DataFrame, tokens: Column, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """doc_len of every document, those without tokens included; counted inside the row."""
    return docs.select(*keys, F.size(tokens).cast("long").alias("doc_len"))


def doc_lengths(postings: DataFrame) -> DataFrame:
    """doc_len from the postings alone."""
    return postings.groupBy("doc_id").agg(F.sum("tf").alias("doc_len"))


def normalized_tf(postings: DataFrame, stats: DataFrame) -> DataFrame:
    """tf over document length, with doc_len and df."""
    return postings.join(stats.select("term", "df"), "term").select(
        "term", "doc_id", (F.col("tf") / F.col("doc_len")).alias("norm_tf"), "doc_len", "df"
    )


def posting_blocks(postings: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Posting lists cut into blocks: (term, block, postings ARRAY<STRUCT<doc_id, tf>>) sorted by doc_id.

    A block covers `block_docs` consecutive ids, which bounds every array even for a
    term that is in all documents.
    """
    return (
        postings.withColumn("block", F.floor(F.col("doc_id") / block_docs))
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))
    )


def posting_lists(postings: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Every posting with its place (from 1) in the doc_id-ordered list of its term.

    Places are counted inside a block and moved by the sizes of the blocks before it,
    so no task orders a whole list.
    """
    blocks = posting_blocks(postings, block_docs)
    sizes = postings.groupBy("term", F.floor(F.col("doc_id") / block_docs).alias("block")).agg(
        F.count(F.lit(1)).alias("n")
    )
    earlier = Window.partitionBy("term").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("term", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return (
        blocks.join(offsets, ["term", "block"])
        .select("term", "offset", F.posexplode("postings").alias("i", "posting"))
        .select(
            "term", (F.col("offset") + F.col("i") + 1).alias("position"), "posting.doc_id", "posting.tf"
        )
    )


def number_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """row_number (from 1) over a unique key of any kind.

    Keys are dealt to ranges by Spark's own sample of them, so sparse keys are spread like dense
    ones, and numbered inside a range. Only the sizes of the ranges, one row a task, pass
    through a window without a partition. The ranges are checkpointed, since a second sample could differ.
    """
    shared_dir(docs.sparkSession)
    ranged = docs.select(key).repartitionByRange(key).withColumn("range", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(key))
    return ranged.withColumn("inside", inside).join(offsets, "range").select(
        key, (F.col("offset") + F.col("inside")).alias("row_number")
    )


def batches(docs: DataFrame, batch_size: int = 1000, key: str = "doc_id") -> DataFrame:
    """(key, batch): batches of `batch_size` documents in key order."""
    return number_rows(docs, key).select(
        key, F.floor((F.col("row_number") - 1) / batch_size).alias("batch")
    )


def batch_indexes(docs: DataFrame, batch_size: int = 1000, text: str = "text", stops: Sequence[str] = ()) -> DataFrame:
    """(batch, term, doc_id, tf): one partial index per batch of documents.

    Texts meet their batch in small parts by document, whose postings lie together: merging them shuffles nothing, and
    what a task holds does not grow with the corpus.
    """
    texts = docs.select("doc_id", text)
    parts = dealt_parts(texts)
    placed = texts.repartition(parts, "doc_id").join(batches(docs, batch_size).repartition(parts, "doc_id"), "doc_id")
    return build_postings(placed, text, stops, keys=["batch", "doc_id"]).drop("doc_len")

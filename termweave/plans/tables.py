"""The given tables seen as corpora, queries, judgements and graphs."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.functions.scoring import rounded
from termweave.functions.stopwords import stop_words
from termweave.operators import graph, index
from termweave.operators.joins import dealt_parts
from termweave.operators.rank import query_terms
from termweave.session import shared_dir
from termweave.sources.corpus import file_digest, folders, is_written, read_corpus, spread, write_ranks
from termweave.sources.index_store import BUCKETS, StoredIndex, buckets_for, open_index, parts_for, write_documents, write_index

STOPS = stop_words("all")
FIELDS = ("body", "title", "anchor")
# Buckets of the index over the tables that the SQL is run on, which are small.
SQL_BUCKETS = BUCKETS[0]
# Tables that the stored index and what lies beside it are made from.
INDEXED = ("documents", "pages", "benchmark", "labels")
TITLE = r"^[^.\n]*"
NAME = r"[\p{L}\p{N}_]+"

# A good document is relevant for a query if it has this share of the query's distinct terms.
RELEVANT_SHARE = 0.25
# The part of the queries, in order of their ids, that parameters are tuned on.
TRAIN_SHARE = 0.667
# Fixed values: (k1, b) and (title weight, body weight) of the parameter search.
BM25_SETTINGS = [(1.4, 0.8), (1.6, 0.7)]
BLEND_WEIGHTS = [(0.35, 0.65), (0.2, 0.8)]


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return read_corpus(spark, f"{sf_dir}/{table}.parquet", columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text)."""
    return spread(read(spark, sf_dir, "documents", "doc_id", "text"))


def document_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title): the first sentence stands in for a title."""
    return documents(spark, sf_dir).select("doc_id", F.regexp_extract("text", TITLE, 0).alias("title"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, title, html)."""
    return spread(read(spark, sf_dir, "pages", "page_id", "html")).select(
        "page_id", text_fn.html_title("html").alias("title"), "html"
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, text)."""
    return read(spark, sf_dir, "benchmark", "item_id", "text").withColumnRenamed("item_id", "query_id")


def benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_terms(benchmark_queries(spark, sf_dir), STOPS)


def judge(spark: SparkSession, sf_dir: str, stored: StoredIndex) -> DataFrame:
    """(query_id, doc_id, grade): labelled good documents that share enough terms with a query, grade 2 unless toxic."""
    terms = benchmark_terms(spark, sf_dir)
    _, found = stored.match(terms, "body")
    shared = found.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = terms.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    labels = read(spark, sf_dir, "labels", "doc_id", "quality", "toxic").where("quality = 1")
    judged = shared.join(labels, "doc_id").join(sizes, "query_id").where(F.col("n") >= RELEVANT_SHARE * F.col("n_terms"))
    return judged.select("query_id", "doc_id", (F.lit(2) - F.col("toxic")).alias("grade"))


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, doc_id, grade) as stored with the index."""
    path = f"{search_index(spark, sf_dir).path}/qrels"
    return spark.read.schema("query_id LONG, doc_id LONG, grade LONG").parquet(path)


def name_of(text: Column | str) -> Column:
    return F.regexp_extract(F.lower(text), NAME, 0)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, target, anchor_text) as written in the pages."""
    return pages(spark, sf_dir).select("page_id", F.inline(text_fn.html_links("html")))


def name_id(name: Column | str) -> Column:
    """The vertex of a name: the first 60 bits of its md5 as a number."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, target_id, anchor_text): every link, to the vertex of the name it has."""
    links = page_links(spark, sf_dir)
    return links.select("page_id", name_id("target").alias("target_id"), "anchor_text")


def named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target_id, page_id, title): the pages that a name in a link may mean, those whose title begins with it."""
    titled = pages(spark, sf_dir).select("page_id", "title", name_of("title").alias("name")).where("name <> ''")
    names = page_links(spark, sf_dir).select("target", name_of("target").alias("name")).distinct()
    return names.join(titled, "name").select(name_id("target").alias("target_id"), "page_id", "title")


def page_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): pages to the names they link to, and names to their pages."""
    links = resolved_links(spark, sf_dir).select(F.col("page_id").alias("src"), F.col("target_id").alias("dst"))
    names = named_pages(spark, sf_dir).select(F.col("target_id").alias("src"), F.col("page_id").alias("dst"))
    return links.unionByName(names)


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph with cycles and sinks: order keys link to part keys in one id space."""
    return read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey").select(
        F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")
    )


def view_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a page-view dump made from the events: project, title, id, access and views."""
    events = read(spark, sf_dir, "events", "event_type", "value", "props")
    page = F.get_json_object("props", "$.k")
    project = F.when(F.col("event_type") == "click", "de.wikipedia").otherwise("en.wikipedia")
    page_field = F.when(F.col("event_type") == "error", "null").otherwise(page)
    views = F.floor(F.abs("value")).cast("string")
    return events.select(
        F.concat_ws(" ", project, F.concat(F.lit("page_"), page), page_field, F.lit("desktop"), views).alias("value")
    )


def _made_from(spark: SparkSession, sf_dir: str, name: str, *table_names: str) -> str:
    """A path under the shared folder that follows from the files of some tables: changed files have another."""
    return f"{shared_dir(spark)}/{name}-{file_digest(spark, [f'{sf_dir}/{t}.parquet' for t in table_names])}"


def stored_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, pagerank, 5 digits) of the order graph as written to sorted files, once per data set."""
    path = _made_from(spark, sf_dir, "pagerank", "lineitem")
    if not is_written(spark, path):
        write_ranks(graph.pagerank(order_edges(spark, sf_dir), rounds=6), path)
    ranks = spark.read.schema("id LONG, pagerank DOUBLE").csv(path)
    return ranks.select("id", rounded("pagerank", 5).alias("pagerank"))


def vector_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, doc_id, tf) under the word pattern of the vectorizer, stored once per data set."""
    path = _made_from(spark, sf_dir, "vector-postings", "documents")
    if not is_written(spark, path):
        built = index.build_postings(documents(spark, sf_dir), "text", stop_words("english"), text_fn.VECTORIZER_PATTERN)
        built.select("term", "doc_id", "tf").write.mode("overwrite").parquet(path)
    return spark.read.schema("term STRING, doc_id LONG, tf LONG").parquet(path)


def stored_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title) as stored with the index."""
    path = f"{search_index(spark, sf_dir).path}/titles"
    return spark.read.schema("doc_id LONG, title STRING").parquet(path)


def stored_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target_id, page_id, title) as stored with the index."""
    path = f"{search_index(spark, sf_dir).path}/names"
    return spark.read.schema("target_id LONG, page_id LONG, title STRING").parquet(path)


def search_index(spark: SparkSession, sf_dir: str) -> StoredIndex:
    """The stored index that the search queries read, opened by its path or else built.

    The folder follows from the files of the tables. A build has a folder of its own in it and counts once it is
    whole, so sessions that build at the same time do not disturb each other.
    """
    folder = _made_from(spark, sf_dir, "index", *INDEXED)
    for path in folders(spark, folder):
        if is_written(spark, f"{path}/qrels"):
            found = open_index(spark, path, FIELDS)
            if found:
                return found
    return build_search_index(spark, sf_dir, f"{folder}/{uuid.uuid4().hex}")


def build_search_index(spark: SparkSession, sf_dir: str, path: str) -> StoredIndex:
    """Fields body and title of the documents, and anchor text by target page.

    The titles, the names of pages and the judgements are stored beside them. What does not need each other
    runs at the same time, since most of these jobs are too small for all cores.
    """
    texts = read(spark, sf_dir, "documents", "doc_id", "text")
    n_buckets = buckets_for(texts)

    def title() -> None:
        document_titles(spark, sf_dir).write.mode("overwrite").parquet(f"{path}/titles")
        titles = spark.read.schema("doc_id LONG, title STRING").parquet(f"{path}/titles")
        write_documents(titles, text_fn.tokens("title", STOPS), path, "title", n_buckets, parts_for(titles, n_buckets))

    def names() -> None:
        named_pages(spark, sf_dir).write.mode("overwrite").parquet(f"{path}/names")

    def anchor() -> None:
        anchors = index.anchor_postings(resolved_links(spark, sf_dir), STOPS)
        lengths = index.doc_lengths(anchors)
        parts = parts_for(read(spark, sf_dir, "pages", "html"), n_buckets)
        write_index(anchors.join(lengths, "doc_id"), lengths, path, "anchor", n_buckets, parts)

    def body() -> None:
        # Tokenizing is heavy work: a split of the table would be one long task.
        dealt = texts.repartition(dealt_parts(texts))
        write_documents(dealt, text_fn.tokens("text", STOPS), path, "body", n_buckets, parts_for(texts, n_buckets))

    with ThreadPoolExecutor(4) as pool:
        for job in [pool.submit(job) for job in (body, title, anchor, names)]:
            job.result()
    stored = StoredIndex(spark, path, n_buckets)
    # The last table to be written says that the index is whole.
    judge(spark, sf_dir, stored).write.mode("overwrite").parquet(f"{path}/qrels")
    return stored

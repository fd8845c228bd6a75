"""Indexes stored as Parquet, partitioned by field and term bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.operators import rank
from termweave.operators.index import count_terms, term_stats
from termweave.operators.joins import dealt_parts, plan_bytes

N_BUCKETS = 124
# Text that a bucket stands for where the number of buckets follows the corpus, and the least and most buckets.
BUCKET_BYTES = 64_000_000
BUCKETS = (8, 4096)
# Parts of buckets, by document, that the postings of a field make at least, and the stored text that a part stands for where
# that needs more. A part is sorted by one task: 1 MB of stored text became about 900,000 postings.
PARTS = 32
PART_BYTES = 1_000_000
# The partition of postings that holds one row a document, with its length and no term.
LENGTHS = -1


def bucket_of(term: Column | str, n_buckets: int = N_BUCKETS) -> Column:
    """The bucket a term belongs to, from the first 32 bits of its md5."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % n_buckets).cast("int")


def buckets_for(docs: DataFrame) -> int:
    """How many buckets suit a corpus, by the size that the optimizer knows of it."""
    return min(BUCKETS[1], max(BUCKETS[0], plan_bytes(docs) // BUCKET_BYTES))


def parts_for(docs: DataFrame, n_buckets: int) -> int:
    """How many parts of a bucket suit a corpus, so that a term of every document is spread over tasks."""
    return max(1, PARTS // n_buckets, plan_bytes(docs) // (n_buckets * PART_BYTES))


# Given at read time, so that opening a table starts no job.
SCHEMAS = {
    "postings": "term STRING, doc_id LONG, tf LONG, doc_len LONG, field STRING, bucket INT",
    "term_stats": "term STRING, df LONG, term_total LONG, field STRING",
    "manifest": "n_docs LONG, n_tokens LONG, n_buckets INT, version INT, field STRING",
}
VERSION = 1


@dataclass(frozen=True)
class StoredIndex:
    """Handle of a stored index. Tables are read when asked for."""

    spark: SparkSession
    path: str
    n_buckets: int = N_BUCKETS

    def _table(self, name: str, field: str | None) -> DataFrame:
        table = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}")
        return table if field is None else table.where(F.col("field") == field).drop("field")

    def postings(self, field: str | None = None) -> DataFrame:
        return self._table("postings", field).where(F.col("bucket") > LENGTHS)

    def term_stats(self, field: str | None = None) -> DataFrame:
        return self._table("term_stats", field)

    def doc_stats(self, field: str | None = None) -> DataFrame:
        """(doc_id, doc_len) of every document: the one partition that has no terms."""
        return self._table("postings", field).where(F.col("bucket") == LENGTHS).drop("term", "tf", "bucket")

    def corpus_stats(self, field: str | None = None) -> DataFrame:
        """(n_docs, n_tokens, n_buckets, version), one row per field."""
        return self._table("manifest", field)

    def lookup(self, name: str, field: str, terms: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of some terms; files of other buckets are not read, nor row groups that cannot have the terms."""
        rows = self._table(name, field).where(F.col("term").isin(list(terms)))
        return rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))

    def match(
        self, terms: DataFrame, field: str, enrich: Callable[[DataFrame], DataFrame] | None = None, by_document: bool = False
    ) -> tuple[DataFrame, DataFrame]:
        """(known, found) of any number of query terms in a field, see `rank.match`.

        The terms meet the postings on bucket and term, so Spark prunes the buckets that no term
        is in when the job runs, and no job runs before it. `by_document` deals them to tasks by document first, for sums by
        query and document.
        """
        placed = terms.withColumn("bucket", bucket_of("term", self.n_buckets))
        postings = self.postings(field)
        parts = dealt_parts(postings) if by_document else None
        known, found = rank.match(placed, postings, self.term_stats(field), enrich=enrich, on=("bucket", "term"), parts=parts)
        return known.drop("bucket"), found.drop("bucket")

    def n_docs(self, field: str) -> Column:
        return self.corpus_stats(field).select("n_docs").scalar()

    def avg_len(self, field: str) -> Column:
        return self.corpus_stats(field).select(F.col("n_tokens") / F.col("n_docs")).scalar()


def write_index(
    postings: DataFrame, docs: DataFrame, path: str, field: str, n_buckets: int = N_BUCKETS, parts: int | None = None
) -> StoredIndex:
    """Store postings(term, doc_id, tf, doc_len) and doc_stats(doc_id, doc_len) as one field of an index."""
    lengths = docs.select(F.lit(None).cast("string").alias("term"), "doc_id", F.lit(0).cast("long").alias("tf"), "doc_len")
    return _store(postings.select("term", "doc_id", "tf", "doc_len").unionByName(lengths), path, field, n_buckets, parts)


def write_documents(
    docs: DataFrame, tokens: Column, path: str, field: str, n_buckets: int = N_BUCKETS, parts: int | None = None
) -> StoredIndex:
    """Store the postings and lengths of docs(doc_id, ...) as one field of an index, in one pass over them.

    A document is tokenized once, into its terms; a row without a term goes along for its length.
    """
    rows = count_terms(docs, tokens, lengths=True)
    return _store(rows.select("term", "doc_id", "tf", "doc_len"), path, field, n_buckets, parts)


def _store(rows: DataFrame, path: str, field: str, n_buckets: int, parts: int | None) -> StoredIndex:
    """Write rows(term, doc_id, tf, doc_len) of a field, those without a term being the lengths of documents.

    The postings of a bucket go to as many tasks as it has parts, by document, so a term that is in every
    document is spread and all tasks have work. A task has one part of one bucket: what it sorts does not grow with the corpus. Files are sorted by term and doc_id, so that row
    groups of other terms are skipped. Statistics come from the stored postings. The manifest is written last: a field without one is not there.
    """
    index = StoredIndex(rows.sparkSession, path, n_buckets)
    parts = parts or max(1, PARTS // n_buckets)

    def store(table: DataFrame, name: str, *parts: str) -> None:
        table.write.mode("overwrite").partitionBy(*parts).parquet(f"{path}/{name}/field={field}")

    place = F.when(F.col("term").isNull(), LENGTHS).otherwise(bucket_of("term", n_buckets))
    bucketed = rows.withColumn("bucket", place)
    # Lengths are the parts before those of bucket 0.
    task = ((F.col("bucket") - LENGTHS) * parts + F.pmod(F.xxhash64("doc_id"), F.lit(parts))).cast("int")
    dealt = bucketed.repartitionById((n_buckets - LENGTHS) * parts, task)
    store(dealt.sortWithinPartitions("bucket", "term", "doc_id"), "postings", "bucket")
    store(term_stats(index.postings(field)).sortWithinPartitions("term"), "term_stats")
    totals = index.doc_stats(field).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("n_tokens")
    )
    store(totals.withColumns({"n_buckets": F.lit(n_buckets), "version": F.lit(VERSION)}), "manifest")
    return index


def open_index(spark: SparkSession, path: str, fields: Sequence[str] = ()) -> StoredIndex | None:
    """The index stored at a path, or None if there is none with all of `fields` in this version."""
    try:
        rows = StoredIndex(spark, path).corpus_stats().where(F.col("version") == VERSION).select("field", "n_buckets").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if not rows or not set(fields) <= {row.field for row in rows}:
        return None
    return StoredIndex(spark, path, rows[0].n_buckets)


def read_index(spark: SparkSession, path: str) -> StoredIndex:
    """Open a stored index; its number of buckets is read from it."""
    return open_index(spark, path) or StoredIndex(spark, path)


def delete_index(index: StoredIndex) -> None:
    """Drop the data of an index; its empty tables stay readable."""
    for name, schema in SCHEMAS.items():
        index.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{index.path}/{name}")


def posting_lookup(index: StoredIndex, terms: Sequence[str], field: str) -> DataFrame:
    """Postings of some terms; only their buckets are read, and in these only row groups that may have them."""
    buckets = [bucket_of(F.lit(term), index.n_buckets) for term in terms]
    return index.lookup("postings", field, terms, buckets)


def bucket_stats(postings: DataFrame) -> DataFrame:
    """(max_terms, min_terms, median_terms) per bucket."""
    sizes = postings.groupBy("bucket").agg(F.count_distinct("term").alias("n"))
    return sizes.agg(
        F.max("n").alias("max_terms"), F.min("n").alias("min_terms"), F.percentile("n", 0.5).alias("median_terms")
    )


def bucket_manifest(index: StoredIndex) -> DataFrame:
    """(field, bucket, n_terms, n_postings): all buckets as partition discovery finds them."""
    return index.postings().groupBy("field", "bucket").agg(
        F.count_distinct("term").alias("n_terms"), F.count(F.lit(1)).alias("n_postings")
    )

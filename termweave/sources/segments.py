"""An index that grows by segments: what is added is written, and nothing else.

A segment is a stored index of its own with the ids that it takes from older segments: those of its documents,
so that a document which comes again replaces its older form, and those that were deleted. A version
is the list of its segments, oldest first; it is written last, so that readers see a change as a whole and
older versions stay readable. Merging reads and writes only the newest segments, as far as each older one is less than FAN times what
is merged, which leaves a number of segments that is logarithmic in the size of the index.

A row without an id takes nothing and cannot be taken. Rows that repeat an id within one addition all stay.
Ids may clash between additions; that is how documents are replaced. An empty addition or deletion changes no rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.operators.index import term_stats
from termweave.sources.index_store import StoredIndex, write_documents, write_index

FAN = 4
LOG = "segment INT, path STRING, weight LONG, n_buckets INT, field STRING"


@dataclass(frozen=True)
class Segment:
    """A stored index and its weight: documents and ids taken, in rows, and 1 at least so that empty ones merge."""

    path: str
    weight: int


@dataclass(frozen=True)
class SegmentedIndex:
    """One version of an index of segments. Every change returns the next version."""

    spark: SparkSession
    path: str
    field: str
    n_buckets: int
    version: int
    segments: tuple[Segment, ...]

    def _stored(self, k: int) -> StoredIndex:
        return StoredIndex(self.spark, self.segments[k].path, self.n_buckets)

    def _taken(self, first: int) -> DataFrame:
        """(doc_id) that the segments from `first` on take from older ones; the oldest segment takes nothing."""
        paths = [f"{s.path}/taken" for s in self.segments[max(first, 1) :]]
        return self.spark.read.schema("doc_id LONG").parquet(*paths).distinct()

    def _live(self, table: str, first: int = 0) -> DataFrame:
        """Rows of a table of the segments from `first` on, without those that a later segment takes."""
        parts = []
        for k in range(first, len(self.segments)):
            rows = getattr(self._stored(k), table)(self.field)
            parts.append(rows.join(self._taken(k + 1), "doc_id", "left_anti") if k + 1 < len(self.segments) else rows)
        return reduce(DataFrame.unionByName, parts)

    def postings(self) -> DataFrame:
        return self._live("postings").select("term", "doc_id", "tf", "doc_len")

    def doc_stats(self) -> DataFrame:
        return self._live("doc_stats").select("doc_id", "doc_len")

    def term_stats(self) -> DataFrame:
        """df and term_total of what is live; the stored statistics where one segment is left."""
        return self._stored(0).term_stats(self.field) if len(self.segments) == 1 else term_stats(self.postings())

    def add(self, docs: DataFrame, tokens: Column) -> SegmentedIndex:
        """With docs(doc_id, ...) in a segment of their own, in place of older documents with their ids."""
        path = self._new_path()
        stored = write_documents(docs, tokens, path, self.field, self.n_buckets)
        return self._next(len(self.segments), path, stored.doc_stats(self.field).select("doc_id"))

    def delete(self, ids: DataFrame) -> SegmentedIndex:
        """Without the documents of ids(doc_id): a segment that holds no document."""
        path = self._new_path()
        none = self.spark.createDataFrame([], "term STRING, doc_id LONG, tf LONG, doc_len LONG")
        write_index(none, none.select("doc_id", "doc_len"), path, self.field, self.n_buckets)
        return self._next(len(self.segments), path, ids.select(F.col("doc_id").cast("long")))

    def merge(self, fan: int = FAN) -> SegmentedIndex:
        """With the newest segments as one, as far as each older one weighs less than `fan` times those."""
        first = len(self.segments) - 1
        total = self.segments[first].weight
        while first > 0 and self.segments[first - 1].weight < fan * total:
            first -= 1
            total += self.segments[first].weight
        return self if first == len(self.segments) - 1 else self._merge_from(first)

    def merge_all(self) -> SegmentedIndex:
        """With one segment."""
        return self if len(self.segments) == 1 else self._merge_from(0)

    def _merge_from(self, first: int) -> SegmentedIndex:
        path = self._new_path()
        write_index(self._live("postings", first), self._live("doc_stats", first), path, self.field, self.n_buckets)
        return self._next(first, path, self._taken(first) if first else None)

    def _new_path(self) -> str:
        return f"{self.path}/segment-{uuid.uuid4().hex}"

    def _next(self, kept: int, path: str, taken: DataFrame | None) -> SegmentedIndex:
        """The next version: the first `kept` segments and a new one, which takes ids from them."""
        n_taken = 0
        if taken is not None:
            taken.where("doc_id IS NOT NULL").distinct().write.parquet(f"{path}/taken")
            n_taken = self.spark.read.schema("doc_id LONG").parquet(f"{path}/taken").count()
        n_docs = StoredIndex(self.spark, path, self.n_buckets).corpus_stats(self.field).first()["n_docs"]
        segments = (*self.segments[:kept], Segment(path, max(1, n_docs + n_taken)))
        return _commit(SegmentedIndex(self.spark, self.path, self.field, self.n_buckets, self.version + 1, segments))


def _commit(index: SegmentedIndex) -> SegmentedIndex:
    """Write the list of segments; a version that another writer has written before fails here."""
    rows = [(k, s.path, s.weight, index.n_buckets, index.field) for k, s in enumerate(index.segments)]
    index.spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(f"{index.path}/log/version={index.version}")
    return index


def start_segments(base: StoredIndex, path: str, field: str) -> SegmentedIndex:
    """A field of a stored index as the oldest segment, which stays where it is."""
    n_docs = base.corpus_stats(field).first()["n_docs"]
    return _commit(SegmentedIndex(base.spark, path, field, base.n_buckets, 0, (Segment(base.path, n_docs),)))


def open_segments(spark: SparkSession, path: str, version: int | None = None) -> SegmentedIndex:
    """The newest version of an index of segments, or a stated one."""
    log = spark.read.schema(f"{LOG}, version INT").parquet(f"{path}/log")
    if version is None:
        version = log.agg(F.max("version")).first()[0]
    rows = log.where(F.col("version") == version).orderBy("segment").collect()
    return SegmentedIndex(spark, path, rows[0].field, rows[0].n_buckets, version, tuple(Segment(r.path, r.weight) for r in rows))

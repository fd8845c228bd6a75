"""Corpora, judgements and dumps."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, path: str, columns: Sequence[str] = ("id", "text")) -> DataFrame:
    """Columns of a Parquet corpus; only these are read."""
    return spark.read.parquet(path).select(*columns)


# Splits up to which an input is spread: with splits of 128 MB no more than 1 GB moves.
FEW_SPLITS = 8


def spread(df: DataFrame) -> DataFrame:
    """`df` with a partition per core where its scan has a few splits, fewer than there are cores.

    Small inputs often are one file with one row group, which one task would read. Any
    larger input is left as it is, also on a cluster with more cores than it has splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits < cores and splits <= FEW_SPLITS else df


def first_rows(corpus: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """The n rows with the lowest keys."""
    return corpus.orderBy(key).limit(n)


DUMP_SCHEMA = """
    id LONG, ns INT, title STRING, redirect STRUCT<_title: STRING>,
    revision STRUCT<text: STRUCT<_VALUE: STRING, _bytes: LONG>>
"""


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, title, body) of the article pages of an XML page dump.

    Redirects and pages outside namespace 0 are left out. bz2 dumps are read in
    splits like plain files.
    """
    pages = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", False).schema(DUMP_SCHEMA).load(path)
    return pages.where("redirect IS NULL AND ns = 0").select(
        F.col("id").alias("page_id"), "title", F.col("revision.text._VALUE").alias("body")
    )


def load_qrels(lines: DataFrame, *keys: str) -> DataFrame:
    """lines(keys, value) of JSON maps text -> [ids] to (keys, query, position, doc_id)."""
    parsed = lines.select(*keys, F.from_json("value", "MAP<STRING, ARRAY<LONG>>").alias("entries"))
    return parsed.select(*keys, F.explode("entries").alias("query", "ids")).select(
        *keys, "query", F.posexplode("ids").alias("position", "doc_id")
    )


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """(query, position, doc_id) of a JSON map; each file is one map, as judgement files are."""
    return load_qrels(spark.read.text(path, wholetext=True))


def write_ranks(ranks: DataFrame, path: str, files: int | None = None) -> None:
    """gzip CSV files (id, pagerank), highest rank first.

    The files are ranges of one global order: read by name they give the sorted list,
    and no task holds all ranks.
    """
    ordered = [F.desc("pagerank"), F.asc("id")]
    placed = ranks.repartitionByRange(files, *ordered) if files else ranks.repartitionByRange(*ordered)
    placed.sortWithinPartitions(*ordered).write.mode("overwrite").csv(path, compression="gzip")


def _files(spark: SparkSession, path: str):
    """Hadoop's view of a path, for any store that Spark reads; starts no job."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def file_digest(spark: SparkSession, paths: Sequence[str]) -> str:
    """A name for the state of some files: it follows from their paths, sizes and times."""
    seen = []
    for path in paths:
        system, where = _files(spark, path)
        status = system.getFileStatus(where)
        parts = system.listStatus(where) if status.isDirectory() else [status]
        seen += [(part.getPath().toString(), part.getLen(), part.getModificationTime()) for part in parts]
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()[:24]


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder, by name; none if it is not there."""
    system, where = _files(spark, path)
    if not system.exists(where):
        return []
    return sorted(part.getPath().toString() for part in system.listStatus(where) if part.isDirectory())


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to a path as a whole."""
    system, where = _files(spark, f"{path}/_SUCCESS")
    return system.exists(where)

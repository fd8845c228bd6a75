"""From raw documents to packed training sequences, in stages that each use one operator.

Every stage works on all rows that the stage before kept, and passes the columns of `documents` on; the
last one returns the packed pieces. An empty table passes through all stages. Rows with a null id are
kept where ids decide, since nothing can be said against them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from termweave.llm import decontaminate, language_id, packing, pii, set_join
from termweave.llm.store import by_ids, short_batches, stored
from termweave.session import scratch_path


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models know; null texts, texts without a letter and rejected ones go.

    The models learn from the documents that name a language.
    """
    short_batches(spark)
    return language_id.known_only(docs, language_id.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates (5 words, 0.8 or more).

    Of rows that share that id one stays. Documents without a word link with nothing and stay.
    """
    short_batches(spark)
    found = stored(set_join.jaccard_components(docs), "groups")
    kept = by_ids(docs, "doc_id", found.where("id <> component").select("id"), "left_anti")
    twice = stored(found.where("id IS NOT NULL AND id = component").groupBy("id").count().where("count > 1").select("id"), "twice")
    if twice.isEmpty():
        return kept
    once = by_ids(kept, "doc_id", twice, "left_anti")
    return once.unionByName(by_ids(kept, "doc_id", twice, "left_semi").dropDuplicates(["doc_id"]))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage aligns with a benchmark item."""
    short_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, decontaminate.contaminated(docs, items))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars is that of the new text."""
    short_batches(spark)
    return pii.mask(docs, pii.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1,024 tokens."""
    short_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_languages),
    ("ngram_jaccard_join", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

#: No stage can be written in SQL: a trained model, set joins with alignment, and a tokenizer. The tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

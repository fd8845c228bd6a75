"""Merging ranked runs (query_id, doc_id, score, rank)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions.scoring import rounded
from termweave.operators.rank import top_n


def _lists(first: DataFrame, *others: DataFrame) -> DataFrame:
    rows = first.select("query_id", "doc_id", "rank", F.lit(0).alias("part"))
    for i, run in enumerate(others):
        rows = rows.unionByName(run.select("query_id", "doc_id", "rank", F.lit(i + 1).alias("part")))
    return rows


def _renumber(rows: DataFrame, dedupe: bool) -> DataFrame:
    """One list per query; the inputs are cut to fixed lengths before, so are these windows."""
    if dedupe:
        best = Window.partitionBy("query_id", "doc_id").orderBy("part", "rank")
        rows = rows.withColumn("copy", F.row_number().over(best)).where("copy = 1").drop("copy")
    order = Window.partitionBy("query_id").orderBy("part", "rank")
    return rows.select("query_id", F.row_number().over(order).alias("rank"), "doc_id", "part")


def blend(body: DataFrame, title: DataFrame, n: int = 20, dedupe: bool = False) -> DataFrame:
    """The body list without its last n, then the first n of the title list.

    As in the contract a body list of n or fewer vanishes and a document may appear
    twice; `dedupe` keeps the first copy.
    """
    sizes = body.groupBy("query_id").agg(F.max("rank").alias("size"))
    kept = body.join(sizes, "query_id").where(F.col("rank") <= F.col("size") - n)
    return _renumber(_lists(kept, title.where(F.col("rank") <= n)), dedupe)


def blend3(
    first: DataFrame, second: DataFrame, n_second: int, third: DataFrame, n_third: int, dedupe: bool = False
) -> DataFrame:
    """Up to 40 of the first list less the other two shares, then n_second, then n_third - 1."""
    sizes = first.groupBy("query_id").agg(F.least(F.lit(40), F.max("rank")).alias("size"))
    kept = first.join(sizes, "query_id").where(F.col("rank") <= F.col("size") - n_second - n_third)
    return _renumber(
        _lists(kept, second.where(F.col("rank") <= n_second), third.where(F.col("rank") <= n_third - 1)), dedupe
    )


def _paired(title: DataFrame, body: DataFrame, by: Sequence[str]) -> DataFrame:
    """Both scores of every document; 0 where a run lacks it."""
    title = title.select(*by, "doc_id", F.col("score").alias("title_score"))
    body = body.select(*by, "doc_id", F.col("score").alias("body_score"))
    return title.join(body, [*by, "doc_id"], "full_outer").fillna(0.0, ["title_score", "body_score"])


def _weighted(title_weight: Column, body_weight: Column) -> Column:
    return rounded(F.col("title_score") * title_weight + F.col("body_score") * body_weight, 5)


def merge_results(
    title: DataFrame, body: DataFrame, title_weight: float = 0.5, body_weight: float = 0.5, n: int = 3
) -> DataFrame:
    """The n best by weighted sum of two runs; a document missing in one has 0 there."""
    score = _weighted(F.lit(float(title_weight)), F.lit(float(body_weight)))
    return top_n(_paired(title, body, ["query_id"]).select("query_id", "doc_id", score.alias("score")), n)


def merge_grid(title: DataFrame, body: DataFrame, weights: Column, n: int, by: Sequence[str]) -> DataFrame:
    """merge_results for every (title_weight, body_weight) of an array column, from one join."""
    rows = _paired(title, body, by).select("*", F.inline(weights))
    by = [*by, "title_weight", "body_weight"]
    score = _weighted(F.col("title_weight"), F.col("body_weight"))
    return top_n(rows.select(*by, "doc_id", score.alias("score")), n, by)

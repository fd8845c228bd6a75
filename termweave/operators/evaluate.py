"""Retrieval metrics of runs (query_id, doc_id, rank) against qrels (query_id, doc_id, grade)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions.scoring import ratio, rounded

METRICS = [
    "recall", "precision", "f_score", "r_precision", "reciprocal_rank", "average_precision", "fallout", "ndcg",
]


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct (query_id, doc_id) found in both."""
    keys = ["query_id", "doc_id"]
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_semi")


def _harmonic(recall: Column, precision: Column) -> Column:
    return rounded(ratio(2.0 * precision * recall, recall + precision), 3)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _thousandths(value: Column) -> Column:
    """A 3-digit number as a whole number, so that sums do not depend on their order."""
    return F.floor(value * 1000.0 + 0.5)


def _mean_of_3_digits(name: str) -> Column:
    return F.sum(_thousandths(F.col(name))) / (1000.0 * F.count(name))


def _discounted(grades: Column) -> Column:
    """Sum of grade / log2(place + 1) over a list in order of place."""
    return _total(F.transform(grades, lambda grade, i: grade / F.log2(i + 2.0)))


def _fold_gain(grades: Column) -> Column:
    """Gain as a fold: the first hit sets it to its grade, a later hit to grade / log2(gain + 1)."""
    return F.aggregate(
        grades,
        F.lit(0.0),
        lambda gain, grade: F.when(gain == 0, grade.cast("double")).otherwise(
            grade / F.log2(F.when(gain == 0, 1.0).otherwise(gain) + 1.0)
        ),
    )


def _average_precision(hits: Column, round_each: bool) -> Column:
    """Mean over the hits of the precision at their rank."""
    precision = F.transform(hits, lambda hit, i: (i + 1.0) / hit["rank"])
    if round_each:
        return _total(F.transform(precision, lambda p: _thousandths(p).cast("double"))) / (1000.0 * F.size(hits))
    return _total(precision) / F.size(hits)


def evaluate(
    run: DataFrame,
    qrels: DataFrame,
    ks: Sequence[int] = (40,),
    by: Sequence[str] = (),
    settings: Column | None = None,
    collection_size: int | Column | None = None,
    ap_rounding: bool = True,
    ndcg: str = "standard",
) -> DataFrame:
    """One row per query and k with all metrics, each rounded to 3 digits.

    Queries of the qrels without results score 0. `by` names columns of the run that tell
    several runs apart and `settings` is an array column with all their values, so that
    runs without any result for a query still count. Fallout divides by the irrelevant
    documents of a collection of `collection_size` documents; without a size the highest
    result id stands in for it. `ap_rounding` rounds the precision at each hit to 3 digits
    before averaging; `ndcg` is standard or recursive.

    One aggregate over the run serves all metrics and all k: it counts over all results
    and keeps the hits among the first max(ks), which bounds the list of a query.
    """
    keys = [*by, "query_id"]
    deepest = max(ks)
    relevant = qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))
    queries = relevant
    if settings is not None:
        queries = relevant.select("query_id", "n_rel", F.inline(settings))

    judged = run.select(*keys, "doc_id", "rank").join(qrels, ["query_id", "doc_id"], "left")
    is_hit = F.col("grade").isNotNull()
    results = (
        judged.join(relevant, "query_id")
        .groupBy(*keys)
        .agg(
            F.count(F.when(is_hit & (F.col("rank") <= F.col("n_rel")), 1)).alias("r_hits"),
            F.max("doc_id").alias("max_id"),
            F.count(F.when(F.col("rank") <= deepest, 1)).alias("n_results"),
            F.sort_array(
                F.collect_list(F.when(is_hit & (F.col("rank") <= deepest), F.struct("rank", "grade")))
            ).alias("hits"),
        )
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("grade"), "doc_id")
    ideal = (
        qrels.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= deepest)
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list("grade"), asc=False).alias("best_grades"))
    )

    rows = queries.join(results, keys, "left").join(ideal, "query_id", "left")
    rows = rows.withColumn("k", F.explode(F.array(*[F.lit(int(k)) for k in ks])))
    hits = F.filter("hits", lambda hit: hit["rank"] <= F.col("k"))
    grades = F.transform(hits, lambda hit: hit["grade"])
    zero = F.lit(0)
    if ndcg == "recursive":
        gain = ratio(_fold_gain(grades), _fold_gain(F.sort_array(grades, asc=False)))
    else:
        dcg = _total(F.transform(hits, lambda hit: hit["grade"] / F.log2(hit["rank"] + 1.0)))
        gain = ratio(dcg, _discounted(F.slice("best_grades", F.lit(1), F.col("k"))))
    n_hits = F.coalesce(F.size(hits), zero)
    shown = F.least(F.coalesce("n_results", zero), F.col("k"))
    recall = rounded(n_hits / F.col("n_rel"), 3)
    precision = rounded(n_hits / F.col("k"), 3)
    size = F.coalesce("max_id", zero) if collection_size is None else F.lit(collection_size)
    ap = F.when(n_hits > 0, _average_precision(hits, ap_rounding))
    return rows.select(
        *keys,
        "k",
        recall.alias("recall"),
        precision.alias("precision"),
        _harmonic(recall, precision).alias("f_score"),
        rounded(F.coalesce("r_hits", zero) / F.col("n_rel"), 3).alias("r_precision"),
        rounded(F.coalesce(1.0 / F.get(hits, zero)["rank"], F.lit(0.0)), 3).alias("reciprocal_rank"),
        rounded(F.coalesce(ap, F.lit(0.0)), 3).alias("average_precision"),
        rounded(ratio((shown - n_hits).cast("double"), size - F.col("n_rel")), 3).alias("fallout"),
        rounded(F.coalesce(gain, F.lit(0.0)), 3).alias("ndcg"),
    )


def mean_metrics(metrics: DataFrame, by: Sequence[str] = (), names: Sequence[str] = METRICS) -> DataFrame:
    """The mean of each metric, 5 digits."""
    return metrics.groupBy(*by).agg(*[rounded(_mean_of_3_digits(m), 5).alias(m) for m in names])


def long_form(metrics: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, metric, value)."""
    pairs = ", ".join(f"'{name}', {name}" for name in names)
    return metrics.selectExpr(*keys, f"stack({len(names)}, {pairs}) as (metric, value)")


def mean_ap_with_misses(results: DataFrame) -> DataFrame:
    """Mean of `ap` (3 digits) where queries without an answer (null) stay in the divisor."""
    total = F.coalesce(F.sum(_thousandths(F.col("ap"))), F.lit(0))
    return results.agg(rounded(ratio(total, 1000.0 * F.count(F.lit(1))), 5).alias("map"))


def mean_speed(log: DataFrame, duration: str = "duration") -> DataFrame:
    """Mean query time of a log."""
    return log.agg(rounded(F.avg(duration), 5).alias("avg_eval_speed"))


def eval_summary(metrics: DataFrame, log: DataFrame) -> DataFrame:
    """Mean recall, f-score, r-precision, speed and MAP in one row; log(query_id, duration)."""
    return metrics.join(log, "query_id", "left").agg(
        *[rounded(_mean_of_3_digits(m), 5).alias(m) for m in ["recall", "f_score", "r_precision"]],
        rounded(F.avg("duration"), 5).alias("avg_eval_speed"),
        rounded(_mean_of_3_digits("average_precision"), 5).alias("map"),
    )


def train_test_split(queries: DataFrame, n_train: int, numbered: DataFrame) -> DataFrame:
    """(query_id, part): the first n_train queries by id train, the rest test; numbered(query_id, row_number)."""
    part = F.when(F.col("row_number") <= n_train, "train").otherwise("test")
    return queries.join(numbered, "query_id").withColumn("part", part).drop("row_number")


def best_setting(means: DataFrame, by: Sequence[str], metric: str = "average_precision") -> DataFrame:
    """The settings with the highest mean; equal means by the settings' own order."""
    order = F.struct(F.col(metric), *[(-F.col(c)).alias(c) for c in by])
    return means.agg(F.max_by(F.struct(*by, metric), order).alias("best")).select("best.*")

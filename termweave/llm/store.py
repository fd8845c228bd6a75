"""Tables that cut lineage, and the components of a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.session import scratch_path


# Rows that go to Python at once; whole texts make a batch of Spark's default of 10,000 too large for small executors.
BATCH_ROWS = 1_000


def short_batches(spark: SparkSession) -> None:
    """Send whole texts to Python in short batches, unless the session has a setting of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again; executors that are lost cost no more than their tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Ids up to which (4 MB) a list of ids is sent to the scan of the rows; a longer one is joined by a shuffle.
SENT_IDS = 500_000


def by_ids(rows: DataFrame, column: str, ids: DataFrame, how: str) -> DataFrame:
    """`rows` whose id is (left_semi) or is not (left_anti) the first column of `ids`; null ids equal each other."""
    ids = stored(ids.select(F.col(ids.columns[0]).alias("_id")).distinct(), "ids")
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, F.col(column).eqNullSafe(F.col("_id")), how)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over edges(a, b), for every id that has an edge to another.

    Alternating large-star and small-star rounds: every id is tied to the smallest id it
    knows until nothing changes, a number of rounds that is logarithmic in the longest
    chain. Ids of hubs meet in joins with one row a hub, which adaptive execution can cut,
    and in aggregates with partial results; no hub is gathered in one task.
    """

    def fingerprint(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    kept = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    kept = stored(kept, "edges")
    state = fingerprint(kept)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = kept.unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        tied = large.join(low, "a")
        small = tied.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        kept = stored(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "edges")
        before, state = state, fingerprint(kept)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = kept.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return roots.unionByName(roots.select(F.col("component").alias("id"), "component").distinct())

"""Link graph and PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.operators.joins import at_most, BROADCAST_ROWS
from termweave.session import shared_dir

# Edges of one source that stay together; a source with more is cut into parts.
EDGES_PER_PART = 1_000_000
# Rounds between two cuts of the lineage.
ROUNDS_PER_CHECKPOINT = 3


def resolve_links(links: DataFrame, names: DataFrame) -> DataFrame:
    """links(page_id, target, anchor_text) ⋈ names(name, target_id) -> (page_id, target_id, anchor_text)."""
    return links.join(names, links.target == names.name).select("page_id", "target_id", "anchor_text")


def link_edges(links: DataFrame, src: str = "page_id", dst: str = "target_id") -> DataFrame:
    """Distinct (src, dst); links of a page to itself stay."""
    return links.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()


def link_vertices(edges: DataFrame) -> DataFrame:
    """Distinct endpoints of the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def _lay_out(df: DataFrame, width: int, *keys: str) -> DataFrame:
    """Checkpoint the distinct rows of `df` partitioned and sorted by `keys`, in a way that later joins on them see.

    The layout of a checkpoint is known to the planner only when the plan that wrote it
    was not adaptive. Copies of a row meet in one partition, so `distinct` needs no
    shuffle of its own.
    """
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.repartition(width, *keys).distinct().sortWithinPartitions(*keys).checkpoint()
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def _part_edges(edges: DataFrame, edges_per_part: int) -> tuple[DataFrame, DataFrame]:
    """(edges with their part, hot(src, parts)): sources with more edges than a part holds, and how many parts they get."""
    counts = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > edges_per_part).select("src", F.ceil(F.col("n") / edges_per_part).alias("parts"))
    # No more than (number of edges / edges_per_part) rows; still counted before they are sent out.
    hot = hot.checkpoint()
    hot = F.broadcast(hot) if at_most(hot, BROADCAST_ROWS) else hot
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1)))
    return edges.join(hot, "src", "left").select("src", part.alias("part"), "dst"), hot


def pagerank(
    edges: DataFrame,
    rounds: int = 6,
    reset: float = 0.15,
    normalize: bool = True,
    edges_per_part: int = EDGES_PER_PART,
    partitions: int | None = None,
) -> DataFrame:
    """(id, pagerank) after `rounds` rounds of r' = reset + (1 - reset) * sum(r_src / outdegree(src)) from 1.0.

    With `normalize` the ranks are scaled to sum up to the number of vertices, which
    matters where pages without links let rank leak out.

    Edges are laid out once by (src, part) and ranks go to them, so a round shuffles
    one row per vertex and the sums per target (combined before their shuffle), never the
    edges. A source with very many links is cut into parts of about `edges_per_part`
    edges; its rank goes to each part. The layouts and every third round are
    checkpointed, so the plan stays short and a lost executor costs few rounds.
    `partitions` is the width of the layout, by default the session's shuffle width.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    parted, hot = _part_edges(edges.select("src", "dst"), edges_per_part)
    laid_out = _lay_out(parted, width, "src", "part")
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("out")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("out")),
    )
    vertices = (
        laid_out.select(F.inline(ends))
        .groupBy("id")
        .agg(F.sum("out").alias("degree"))
        .join(hot.withColumnRenamed("src", "id"), "id", "left")
        .select("id", "degree", F.coalesce("parts", F.lit(1)).alias("parts"))
    )
    vertices = _lay_out(vertices, width, "id")

    ranks = vertices.withColumn("pagerank", F.lit(1.0))
    for done in range(1, rounds + 1):
        shares = ranks.where("degree > 0").select(
            F.col("id").alias("src"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            (F.col("pagerank") / F.col("degree")).alias("share"),
        )
        received = (
            laid_out.join(shares, ["src", "part"])
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum("share").alias("received"))
        )
        rank = F.lit(reset) + F.lit(1.0 - reset) * F.coalesce("received", F.lit(0.0))
        ranks = vertices.join(received, "id", "left").select("id", "degree", "parts", rank.alias("pagerank"))
        if done % ROUNDS_PER_CHECKPOINT == 0 or done == rounds:
            ranks = ranks.checkpoint()
    if normalize:
        totals = ranks.agg((F.count(F.lit(1)) / F.sum("pagerank")).alias("scale"))
        return ranks.select("id", (F.col("pagerank") * totals.scalar()).alias("pagerank"))
    return ranks.select("id", "pagerank")


def top_ranked(ranks: DataFrame, n: int, digits: int = 6) -> DataFrame:
    """(place, id, pagerank) of the n highest ranks, equal ranks by id."""
    best = ranks.select("id", (F.floor(F.col("pagerank") * 10.0**digits + 0.5) / 10.0**digits).alias("pagerank"))
    best = best.orderBy(F.desc("pagerank"), "id").limit(n)
    # n rows are left, so listing their places needs no partitions.
    listed = best.agg(F.sort_array(F.collect_list(F.struct((-F.col("pagerank")).alias("k"), "id"))).alias("rows"))
    return listed.select(F.posexplode("rows").alias("i", "row")).select(
        (F.col("i") + 1).alias("place"), "row.id", (-F.col("row.k")).alias("pagerank")
    )


def lookup(ids: DataFrame, values: DataFrame, value: str, key: str = "id") -> DataFrame:
    """request(request_id, ids ARRAY<LONG>) -> one row per asked id in order, 0 where unknown."""
    asked = ids.select("request_id", F.posexplode("ids").alias("position", key))
    zero = F.lit(0).cast(values.schema[value].dataType)
    return asked.join(values.select(key, value), key, "left").select(
        "request_id", "position", key, F.coalesce(value, zero).alias(value)
    )

"""Link graph, PageRank and page views."""

from __future__ import annotations

from pyspark.sql import functions as F

from termweave.functions.scoring import rounded
from termweave.operators import graph, views
from termweave.plans import sql, tables
from termweave.plans.registry import query

PAGE_EDGES = f"{sql.RESOLVED}, edges AS (SELECT DISTINCT page_id AS src, target_id AS dst FROM resolved)"
PAGE_GRAPH = f"""{sql.RESOLVED}, edges AS (SELECT page_id AS src, target_id AS dst FROM resolved
    UNION SELECT target_id, page_id FROM named)"""
ORDER_EDGES = "edges AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem)"


@query("link_edges", f"WITH {PAGE_EDGES} SELECT src, dst FROM edges")
def link_edges(spark, sf_dir):
    return graph.link_edges(tables.resolved_links(spark, sf_dir))


@query("link_vertices", f"WITH {PAGE_EDGES} SELECT src AS id FROM edges UNION SELECT dst FROM edges")
def link_vertices(spark, sf_dir):
    return graph.link_vertices(graph.link_edges(tables.resolved_links(spark, sf_dir)))


@query("pagerank", f"WITH {ORDER_EDGES}, {sql.pagerank('edges', 6)} SELECT id, pagerank FROM pr")
def pagerank(spark, sf_dir):
    ranks = graph.pagerank(tables.order_edges(spark, sf_dir), rounds=6)
    return ranks.select("id", rounded("pagerank", 5).alias("pagerank"))


PLACES = [1, 4, 5]


@query(
    "top_pagerank_pages",
    f"""WITH {PAGE_GRAPH}, {sql.pagerank("edges", 10)},
    placed AS (SELECT id, title, pagerank, row_number() OVER (ORDER BY pagerank DESC, id) AS place
        FROM pr JOIN page_titles ON page_id = id)
    SELECT place::INT AS place, id, title, pagerank FROM placed
    WHERE place IN (1, 4, 5)""",
)
def top_pagerank_pages(spark, sf_dir):
    """The pages at places 1, 4 and 5 among pages, after 10 rounds over pages and names."""
    titles = tables.pages(spark, sf_dir).select(F.col("page_id").alias("id"), "title")
    ranks = graph.pagerank(tables.page_graph(spark, sf_dir), rounds=10).join(titles.select("id"), "id", "left_semi")
    best = graph.top_ranked(ranks, max(PLACES), digits=5).where(F.col("place").isin(PLACES))
    return best.join(titles, "id").select("place", "id", "title", "pagerank")


def _requests(spark, sf_dir):
    """(request_id, ids): a request per order for its parts, in line order."""
    lines = tables.read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    by_line = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    return lines.groupBy(F.col("l_orderkey").alias("request_id")).agg(
        F.transform(by_line, lambda line: line["l_partkey"]).alias("ids")
    )


REQUESTS = """asked AS (SELECT l_orderkey AS request_id, l_partkey AS id,
        (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1)::INT AS position
        FROM lineitem)"""


@query(
    "pagerank_lookup",
    f"""WITH {ORDER_EDGES}, {sql.pagerank("edges", 6)}, {REQUESTS}
    SELECT request_id, position, id, coalesce(pagerank, 0) AS pagerank FROM asked LEFT JOIN pr USING (id)""",
)
def pagerank_lookup(spark, sf_dir):
    """Stored ranks of the order graph for lists of its ids."""
    return graph.lookup(_requests(spark, sf_dir), tables.stored_ranks(spark, sf_dir), "pagerank")


VIEWS = """views AS (SELECT page_id, sum(n)::BIGINT AS views FROM (
        SELECT (props ->> '$.k')::BIGINT AS page_id, floor(abs(value))::BIGINT AS n FROM events
        WHERE event_type NOT IN ('click', 'error')) GROUP BY 1)"""


@query(
    "pageview_lookup",
    f"""WITH {VIEWS}, {REQUESTS} SELECT request_id, position, id, coalesce(views, 0) AS views
    FROM asked LEFT JOIN views ON page_id = id""",
)
def pageview_lookup(spark, sf_dir):
    counted = views.aggregate_views(tables.view_events(spark, sf_dir)).withColumnRenamed("page_id", "id")
    return graph.lookup(_requests(spark, sf_dir), counted, "views")


@query("pageviews_aggregate", f"WITH {VIEWS} SELECT page_id, views FROM views")
def pageviews_aggregate(spark, sf_dir):
    return views.aggregate_views(tables.view_events(spark, sf_dir))


@query(
    "most_viewed",
    f"""WITH {VIEWS}, {sql.PAGE_TITLES} SELECT page_id, title, coalesce(views, 0) AS views
    FROM page_titles LEFT JOIN views USING (page_id) ORDER BY views DESC, page_id""",
)
def most_viewed(spark, sf_dir):
    pages = tables.pages(spark, sf_dir).select("page_id", "title")
    return views.most_viewed(pages, views.aggregate_views(tables.view_events(spark, sf_dir)))

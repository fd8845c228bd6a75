"""Page views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aggregate_views(lines: DataFrame, project: str = "en.wikipedia") -> DataFrame:
    """lines(value) of a page-view dump -> (page_id, views).

    Fields are separated by spaces: the project is the first, the article id the third
    and the number of views the fifth. Lines of other projects and lines whose id or
    views are not digits are left out.
    """
    fields = F.split("value", " ")
    parsed = lines.where(F.col("value").startswith(project)).select(
        F.get(fields, F.lit(2)).alias("page_id"), F.get(fields, F.lit(4)).alias("views")
    )
    digits = parsed.where(F.col("page_id").rlike("^[0-9]+$") & F.col("views").rlike("^[0-9]+$"))
    return digits.groupBy(F.col("page_id").cast("long").alias("page_id")).agg(
        F.sum(F.col("views").cast("long")).alias("views")
    )


def most_viewed(pages: DataFrame, views: DataFrame) -> DataFrame:
    """(page_id, title, views) of all pages, most viewed first, 0 without views."""
    return (
        pages.join(views, "page_id", "left")
        .select("page_id", "title", F.coalesce("views", F.lit(0).cast("long")).alias("views"))
        .orderBy(F.desc("views"), "page_id")
    )

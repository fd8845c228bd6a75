"""Operator 9: URL filters whose entries have dates, joined with captures as of their fetch time.

A list entry (list, pattern, action, at) adds or removes a pattern at a time. Entries become intervals in which
the pattern is active; a capture is joined with the intervals of its host and of every parent domain
that hold its fetch time. An entry of an allow list overrides all block lists.

DataFrame functions only. Intervals are found within months first, so a pattern with very many
entries is spread over tasks; the months of a pattern meet in a window of one row a month. Captures of one
large host are spread by adaptive execution, since the join needs no more than pattern and time.

Of entries for one list, pattern and time, `add` wins over `remove`. Entries without a list, pattern or time are left out, actions other
than `add` count as `remove`. A capture with a null or unreadable URL, or without a time, comes out as not blocked. Hosts
compare in lower case, without port, user or the final dot. Rows that repeat come out as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column | str) -> Column:
    """The host of a URL in lower case; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    name = F.regexp_replace(F.regexp_replace(authority, r"^[^@]*@", ""), r":[0-9]*$", "")
    name = F.lower(F.regexp_replace(name, r"\.$", ""))
    return F.when(name != "", name)


def domains_of(host: Column | str) -> Column:
    """The host and every parent domain, longest first; an empty list for null."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    every = F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, k, n), "."))
    host = F.col(host) if isinstance(host, str) else host
    return F.when(host.isNotNull(), every).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) in which a pattern is active; valid_to is null for the open one."""
    known = entries.where("list IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL")
    at_once = known.groupBy("list", F.lower("pattern").alias("pattern"), "at").agg(F.max(F.coalesce(F.col("action") == "add", F.lit(False))).alias("active"))
    dated = at_once.withColumn("month", F.trunc("at", "month"))
    months = dated.groupBy("list", "pattern", "month").agg(F.min("at").alias("first_at"))
    by_month = Window.partitionBy("list", "pattern").orderBy("month")
    months = months.select("list", "pattern", "month", F.lead("first_at").over(by_month).alias("next_month_at"))
    within = Window.partitionBy("list", "pattern", "month").orderBy("at")
    steps = dated.withColumn("next_at", F.lead("at").over(within)).join(months, ["list", "pattern", "month"])
    return steps.where("active").select("list", "pattern", F.col("at").alias("valid_from"), F.coalesce("next_at", "next_month_at").alias("valid_to"))


def filter_captures(captures: DataFrame, entries: DataFrame, allow: str = "allow", key: str = "page_id", url: str = "url", at: str = "fetched_at") -> DataFrame:
    """(key, host, fetched_at, blocked, lists, pattern) of every capture: the lists active for it then, and the longest pattern."""
    rows = captures.select(F.col(key), host_of(F.col(url)).alias("host"), F.col(at).alias("fetched_at"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    spans = validity_intervals(entries)
    keys = rows.select("row", key, "host", "fetched_at", F.explode_outer(domains_of("host")).alias("domain"))
    active = (F.col("domain") == F.col("pattern")) & (F.col("fetched_at") >= F.col("valid_from"))
    active = active & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    met = keys.join(spans, active, "left").groupBy("row", key, "host", "fetched_at")
    out = met.agg(F.array_sort(F.collect_set("list")).alias("lists"), F.max(F.struct(F.length("pattern"), "pattern")).alias("longest"))
    blocked = (F.size("lists") > 0) & ~F.array_contains("lists", allow)
    return out.select(key, "host", "fetched_at", blocked.alias("blocked"), "lists", F.col("longest.pattern").alias("pattern"))

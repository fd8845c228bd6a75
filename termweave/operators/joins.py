"""Joins between large postings and a query side that is small in most jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which a run is sent to every executor.
BROADCAST_ROWS = 500_000
# Bytes up to which the optimizer's size of a query side lets it be sent to every executor.
BROADCAST_BYTES = 32_000_000
# Stored bytes that a task gets where the work on them, or what it holds of them, is many times as much.
DEALT_BYTES = 4_000_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether `df` has no more than `rows` rows; reads at most one row more."""
    return df.limit(rows + 1).count() <= rows


def plan_bytes(df: DataFrame) -> int:
    """The size that the optimizer knows of a plan, from the sizes of its files; starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dealt_parts(df: DataFrame) -> int:
    """Tasks for heavy work on what a plan reads: splits and coalesced partitions follow bytes alone, and tens of megabytes would be one long task."""
    return max(df.sparkSession.sparkContext.defaultParallelism, plan_bytes(df) // DEALT_BYTES)


def join_by_term(large: DataFrame, small: DataFrame, fits: bool, on: Sequence[str] = ("term",)) -> DataFrame:
    """Inner join on the term: `small` is broadcast where it `fits`.

    Otherwise both sides shuffle, and adaptive execution cuts the postings of a term that is in every
    document into parts, each with a copy of its query rows.
    """
    return large.join(F.broadcast(small) if fits else small, list(on))

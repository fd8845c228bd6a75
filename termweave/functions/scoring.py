"""Column expressions for term weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Added to df in query weights.
DF_EPSILON = 1e-7


def col(value: Column | str | float | int) -> Column:
    """A column from a name, a number or a column."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def rounded(value: Column | str, digits: int) -> Column:
    """Half-up rounding in plain double arithmetic."""
    scale = float(10**digits)
    return F.floor(col(value) * scale + 0.5) / F.lit(scale)


def ratio(part: Column | str, whole: Column | str | float) -> Column:
    """part / whole, 0 where whole is 0."""
    whole = col(whole)
    return F.when(whole == 0, 0.0).otherwise(col(part) / F.when(whole != 0, whole))


def log10_idf(n_docs: Column | float, df: Column | str = "df", epsilon: float = 0.0) -> Column:
    """log10(N / (df + epsilon))."""
    return F.log10(col(n_docs) / (col(df) + F.lit(float(epsilon))))


def bm25_idf(n_docs: Column | float, df: Column | str = "df") -> Column:
    """ln(1 + (N - df + 0.5) / (df + 0.5))."""
    df = col(df)
    return F.ln(1.0 + (col(n_docs) - df + 0.5) / (df + 0.5))


def bm25_weight(tf: Column, doc_len: Column, avg_len: Column | float, k1: Column | float, b: Column | float) -> Column:
    """tf (k1 + 1) / (tf + k1 (1 - b + b doc_len / avg_len))."""
    k1, b = col(k1), col(b)
    return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * doc_len / col(avg_len)))

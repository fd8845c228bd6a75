"""Comparison of a registered query with its SQL in DuckDB.

As a script: python tests/oracle.py SF_DIR [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value."""
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None; values must be equal, not close."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got, want = canonical(got), canonical(want)
    for name in got.columns:
        if got[name].dtype.kind != want[name].dtype.kind:
            return f"{name}: type {got[name].dtype} != {want[name].dtype}"
        unequal = ~((got[name] == want[name]) | (got[name].isna() & want[name].isna()))
        if unequal.any():
            i = unequal.idxmax()
            return f"{name}: {unequal.sum()} values differ, first {got.loc[i].to_dict()} != {want.loc[i].to_dict()}"
    return None


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as entry
    from termweave.session import build_session

    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                "spark.ui.showConsoleProgress": "false"}
    spark = build_session("oracle", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - start
            if name in sql:
                problem = differences(got, con.execute(sql[name]).df())
            else:
                problem = None if len(got) else "no rows"
        except Exception as error:  # noqa: BLE001
            took, got = time.time() - start, []
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in sql else "rows"
        print(f"{name:26s} {kind:4s} {took:6.2f}s {len(got):8d} rows  {problem or 'ok'}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

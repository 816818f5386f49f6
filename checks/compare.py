"""Run registered queries next to their SQL: ``python -m checks.compare [folder] [names...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from bazaarlake.session import build_session
from checks import oracle, registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value: object) -> str:
    if value is None or value is pd.NaT or value != value:
        return "~"
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        return f"{float(value):.6f}"
    if isinstance(value, pd.Timestamp) or hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, db, folder: str, name: str) -> str:
    """Empty text when equal, else what differs first."""
    df = registry.queries()[name](spark, folder)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    theirs = canonical(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{sorted(columns)}: {mine} != {other}"
    return ""


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.queries())
    spark = build_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                             "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(folder), 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = compare(spark, db, folder, name)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        seconds = time.perf_counter() - start
        print(f"{'FAIL' if problem else 'ok':5}{seconds:6.1f}s {name} {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")


if __name__ == "__main__":
    main()

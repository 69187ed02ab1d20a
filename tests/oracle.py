"""Compare registered queries with their SQL counterpart; also runnable by hand.

    python tests/oracle.py SF_DIR [NAME ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(value: object) -> str:
    return type(value).__name__


def normal(row: tuple) -> tuple:
    return tuple(
        "NULL" if it is None or (isinstance(it, float) and math.isnan(it)) else f"{kind(it)}:{it!r}"
        for it in row
    )


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda idx: columns[idx])
    return sorted(normal(tuple(row[idx] for idx in order)) for row in rows)


def compare(spark, con, name: str, func, sql: str, sf_dir: str) -> str | None:
    """None if both sides agree, otherwise what differs."""
    start = time.time()
    df = func(spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    print(f"[{time.time() - start:6.2f}s]", end=" ")
    actual = sorted_rows(df.columns, rows)
    result = con.execute(sql)
    columns = [it[0] for it in result.description]
    expected = sorted_rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for left, right in zip(actual, expected, strict=True):
        if left != right:
            return f"{sorted(columns)}: {left} != {right}"
    if not actual:
        return "no rows"
    return None


def main(argv: list[str]) -> int:
    from helixframe.catalog import ORACLES, QUERIES
    from helixframe.plans.session import local_session

    sf_dir, names = argv[0], argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                error = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                error = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as exc:  # noqa: BLE001
            error = f"{kind(exc)}: {str(exc)[:500]}"
        failures += error is not None
        label = "ok" if error is None else "FAIL"
        if name not in ORACLES:
            label += " (no sql)"
        print(f"{name:32s} {time.time() - start:6.2f}s {label} {error or ''}", flush=True)
    print(f"{failures} failures")
    return int(failures > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

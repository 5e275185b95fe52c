"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows.

    python -m verification.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLE_NAMES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, connection, sql: str) -> str:
    """Empty when both sides hold the same columns and rows, else what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    got = rows_of(result.columns, result.collect())
    if got == expected:
        return ""
    extra, lacking = got - expected, expected - got
    return (
        f"rows {got.total()} vs {expected.total()}; only Spark {extra.total()}: "
        f"{list(extra)[:2]}; only SQL {lacking.total()}: {list(lacking)[:2]}"
    )


def main() -> int:
    from meterlark.session import build_session
    from verification import oracle, registry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(registry.QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection, statements = connect(sf_dir), oracle.statements()
    failed = 0
    for name in chosen:
        started = time.time()
        try:
            result = registry.QUERIES[name](spark, sf_dir)
            if name in statements:
                problem = difference(result, connection, statements[name])
                verdict = problem or "equal"
            else:
                problem, verdict = "", f"{len(result.collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem = verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:32s} {time.time() - started:6.2f}s  {verdict}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

"""Compare Spark results with DuckDB results as multisets of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
            )
    return connection


def duck_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def duck_types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}


def spark_rows(frame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    return names, Counter(tuple(row) for row in frame.select(*names).collect())

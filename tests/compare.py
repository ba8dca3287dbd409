"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as connection:
        for table in Path(sf_dir).glob("*.parquet"):
            connection.execute(
                f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')"
            )
        result = connection.execute(sql)
        return [column[0] for column in result.description], result.fetchall()


def bag(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(row[i] for i in order) for row in rows),
    )


def spark_bag(df) -> tuple[list[str], Counter]:
    return bag(df.columns, [tuple(row) for row in df.collect()])


def duckdb_bag(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    return bag(*duckdb_rows(sf_dir, sql))

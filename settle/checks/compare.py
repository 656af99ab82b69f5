"""Compare a registered query with its oracle."""

from __future__ import annotations

import duckdb
from pyspark.sql import SparkSession

from settle.checks.all_queries import ORACLES, QUERIES
from settle.checks.registry import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(rows) -> list[str]:
    return sorted(repr(tuple(row)) for row in rows)


def spark_rows(spark: SparkSession, folder: str, name: str) -> tuple[list[str], list[str]]:
    """Sorted columns and rows of the query."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    return columns, _rows(df.select(*[f"`{c}`" for c in columns]).collect())


def oracle_rows(con: duckdb.DuckDBPyConnection, name: str) -> tuple[list[str], list[str]]:
    """Sorted columns and rows of the oracle."""
    columns = sorted(con.sql(ORACLES[name]).columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    return columns, _rows(con.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall())

"""Catalog and parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table by name, or a parquet path; only the columns asked for."""
    df = spark.read.parquet(name) if "/" in name else spark.read.table(name)
    return df.select(*columns) if columns else df


def sink_table(
    df: DataFrame, target: str, mode: str = "errorifexists", by: list[str] | None = None
) -> None:
    """Save to a parquet path or, for a bare name, as a catalog table.

    The default mode fails if the target exists; `overwrite` also replaces the
    schema. With `by`, rows are brought together by those columns first, so a
    partition gets few files, and a hot partition is split by adaptive execution.
    """
    writer = df.hint("rebalance", *by).write.partitionBy(*by) if by else df.write
    writer = writer.mode(mode)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)

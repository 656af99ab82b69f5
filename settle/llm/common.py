"""Helpers of the corpus operators: batches, held-out rows, stored intermediates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.session import fresh_path

# Characters of text that a task holds in its working arrays at once.
CHUNK_CHARS = 500_000


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that long texts cannot pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back.

    It is computed once, survives the loss of executors, and gives the same
    rows to every later step.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the rows no classifier may learn from; null ids count as the text 'null'."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % 4 == 2


def chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of up to `most` characters, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of a column; null counts as empty."""
    return [text or "" for text in column.to_pylist()]

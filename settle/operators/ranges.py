"""Date bounds and clipping, without bringing values to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.session import once

FLOOR = "2015-01-01"


def from_floor(df: DataFrame, date: str, floor: str = FLOOR) -> DataFrame:
    return df.where(F.col(date) >= F.lit(floor).cast("date"))


def bounds(df: DataFrame, date: str) -> DataFrame:
    """One row: first and last date."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def overlap(*ranges: DataFrame) -> DataFrame:
    """One row: latest of the first dates, earliest of the last dates.

    Computed once, so that a range which depends on another does not carry the
    plan of that one along each time it is used.
    """
    every = reduce(DataFrame.unionByName, ranges)
    # A side without rows has no dates, so nothing overlaps with it.
    bare = F.count_if(F.col("min_date").isNull()) > 0
    return once(every.agg(
        F.when(~bare, F.max("min_date")).alias("min_date"),
        F.when(~bare, F.min("max_date")).alias("max_date"),
    ))


def limit_columns(limits: DataFrame) -> tuple[Column, Column]:
    """The two dates of a one-row table as scalar subqueries."""
    return limits.select("min_date").scalar(), limits.select("max_date").scalar()


def clip(df: DataFrame, date: str, limits: DataFrame) -> DataFrame:
    """Rows inside `limits`; the two dates reach the scan as a filter."""
    low, high = limit_columns(limits)
    return df.where(F.col(date).between(low, high))

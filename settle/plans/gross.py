"""Gross demand: area tables and large transmission demand together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.operators import measures, ranges
from settle.session import stage


def p315(half_hourly: DataFrame, profiled: DataFrame) -> DataFrame:
    """Half-hourly and profiled tables of the same kind, from 2015 on."""
    both = half_hourly.unionByName(profiled, allowMissingColumns=True)
    return ranges.from_floor(both, "date")


def gross_demand(p315_hh: DataFrame, big_demand: DataFrame) -> DataFrame:
    """Area demand plus transmission demand on the dates of the area demand."""
    inside = ranges.clip(big_demand, "date", ranges.bounds(p315_hh, "date"))
    return p315_hh.unionByName(inside, allowMissingColumns=True)


def gross_daily(p315_hh: DataFrame, big_demand: DataFrame) -> DataFrame:
    """Day totals of gross demand.

    The two sides have no key in common, so each is summed by day first; the
    dates of the area demand are then looked up in its few day rows.
    """
    area, transmission = [measures.day_totals(df, meters=F.sum) for df in (p315_hh, big_demand)]
    return gross_demand(stage(area, "area_daily"), transmission)

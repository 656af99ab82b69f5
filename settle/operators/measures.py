"""Volumes: scaling, loss correction and totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Volumes that day and peak tables add up; the meter count is treated apart.
VOLUMES = [
    "uncorrected_consumption_gwh",
    "uncorrected_line_loss_gwh",
    "corrected_consumption_gwh",
    "corrected_line_loss_gwh",
    "total_corrected_consumption_gwh",
    "total_uncorrected_consumption_gwh",
]

DAY_KEYS = [
    "date", "settlement_run", "gsp_area", "aggregation_type",
    "description", "sector", "actual_estimate",
]

PROFILE_MEASURES = {"eac": ["f"], "advance": ["h"], "unmetered": ["j"]}

# Annual measures that take line losses.
LOSSY = ["f", "h", "j"]


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def import_volumes(df: DataFrame) -> DataFrame:
    """MWh to GWh; corrected volumes also take the loss multiplier."""
    scaled = {
        "uncorrected_consumption_gwh": F.col("a") / 1000,
        "uncorrected_line_loss_gwh": F.col("h") / 1000,
        "corrected_consumption_gwh": F.col("m") * F.col("off_taking") / 1000,
        "corrected_line_loss_gwh": F.col("c") * F.col("off_taking") / 1000,
    }
    return add_totals(df.withColumns(scaled))


def export_volumes(df: DataFrame) -> DataFrame:
    """As for imports, but the loss multiplier goes only into a total of its own."""
    scaled = {
        "uncorrected_consumption_gwh": F.col("a") / 1000,
        "uncorrected_line_loss_gwh": F.col("h") / 1000,
        "corrected_consumption_gwh": F.col("m") / 1000,
        "corrected_line_loss_gwh": F.col("c") / 1000,
    }
    total = F.col("total_corrected_consumption_gwh") * F.col("off_taking")
    return add_totals(df.withColumns(scaled)).withColumn("total_tlm_corrected_consumption_gwh", total)


def add_totals(df: DataFrame) -> DataFrame:
    """Consumption plus line loss, a missing part counting as 0."""
    parts = {
        f"total_{kind}_consumption_gwh": zero_if_null(F.col(f"{kind}_consumption_gwh"))
        + zero_if_null(F.col(f"{kind}_line_loss_gwh"))
        for kind in ("corrected", "uncorrected")
    }
    return df.withColumns(parts)


def profile_volumes(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Four volumes for the annual measures of a name together: plain and corrected, with losses.

    Needs `pc` (share of the period), `factor` (grid correction times loss
    multiplier) and the line loss of each measure (`f_lost` of `f`).
    """
    made = {}
    for name, annual in names.items():
        whole = reduce(Column.__add__, [F.col(c) for c in annual])
        lost = reduce(Column.__add__, [F.col(f"{c}_lost") for c in annual])
        for prefix, share in (("", F.col("pc")), ("corrected_", F.col("pc") * F.col("factor"))):
            made[f"{prefix}{name}_gwh"] = whole / 1000 * share
            made[f"{prefix}{name}_loss_gwh"] = lost / 1000 * share
    return df.withColumns(made)


def sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def day_totals(df: DataFrame, meters=F.avg) -> DataFrame:
    """Day table of half-hourly rows; meters are averaged unless told otherwise."""
    return df.groupBy(*DAY_KEYS).agg(*sums(*VOLUMES), meters("meters_count").alias("meters_count"))


def peak_totals(df: DataFrame) -> DataFrame:
    return day_totals(df.where(F.col("peak") == "P"))

"""Choice of the latest settlement run.

Each flow looks for the latest run at its own grain. The grains are here in one
place, because a wrong list gives plausible but wrong totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settle.functions.flags import all_present

HALF_HOUR = ["date", "settlement_period"]
DAY = ["date"]
UNIT_PERIOD = ["settlementdate", "settlementperiod", "bmunitid"]
UNIT_DIRECTION = UNIT_PERIOD + ["importexportindicator"]
CLASS_PERIOD = ["date", "settlement_period", "description"]
SCHEME = [
    "date", "gsp_area", "settlement_period",
    "aggregation_type", "description", "actual_estimate",
]


def latest_rank(df: DataFrame, keys: list[str], rank) -> DataFrame:
    """Highest rank by key; combined on the map side, so a hot key is no burden."""
    return (
        df.where(all_present(*keys))
        .groupBy(*keys)
        .agg(F.max(rank).alias("_best"))
        .where(F.col("_best").isNotNull())
    )


def flag_last_run(df: DataFrame, best: DataFrame, keys: list[str], rank, out="last_run_flag"):
    """Mark rows of the latest run; an unknown run or a null key is not marked.

    For raw rows. The maxima are aggregated first and joined back, since a
    window would bring all rows of a key into one task.
    """
    flag = F.coalesce(rank == F.col("_best"), F.lit(False))
    return df.join(best, keys, "left").withColumn(out, flag).drop("_best")


def keep_last_run(df: DataFrame, best: DataFrame, keys: list[str], rank, distinct: bool = False) -> DataFrame:
    """Rows of the latest run only, each once if `distinct`.

    Copies are dropped while the rank is still there: the rows then lie as the
    join left them, and dropping copies moves nothing.
    """
    kept = df.withColumn("_best", rank).join(best, [*keys, "_best"], "left_semi")
    return (kept.dropDuplicates() if distinct else kept).drop("_best")


def flag_last_run_of_totals(df: DataFrame, keys: list[str], ranks: dict) -> DataFrame:
    """Mark the latest run in a table of totals, one flag for each rank given.

    For aggregated tables only: a key then has at most one row for each run,
    file and code, so the window holds a few rows however many were summed.
    A null rank takes no part.
    """
    window = Window.partitionBy(*keys)
    flags = {
        out: F.coalesce(rank == F.max(rank).over(window), F.lit(False))
        for out, rank in ranks.items()
    }
    return df.withColumns(flags)


def last_version(df: DataFrame, unit="bmu_id", since="effective_from_date", out="last_flag"):
    """Mark the version of each unit that came into force last."""
    best = df.groupBy(unit).agg(F.max(since).alias("_last"))
    flag = F.coalesce(F.col(since) == F.col("_last"), F.lit(False))
    return df.join(best, unit, "left").withColumn(out, flag).drop("_last")

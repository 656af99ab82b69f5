"""Unit gross demand (report C0421) and large transmission demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.functions.flags import actual_estimate, all_present, peak, run_rank
from settle.functions.text import date_of, integer, number, period, player, try_date
from settle.operators import ranges, runs
from settle.operators.measures import VOLUMES
from settle.plans import units
from settle.session import bounded
from settle.sources.codes import BIG_DEMAND_CLASSES

UNUSED = ["dataflowid", "cdcarunnumber", "dateofaggregation", "inserteddate"]

BIG_DEMAND_KEYS = [
    "settlementdate", "settlementruntype", "settlementperiod", "estimateindicator", "enapp_class",
]


# Fields that a row must not lose without a word.
READABLE = {"settlementdate": try_date, "settlementperiod": integer}


def parse(raw: DataFrame) -> DataFrame:
    parsed = raw.drop(*UNUSED).withColumns({
        "settlementdate": date_of(raw, "settlementdate"),
        "settlementperiod": period("settlementperiod"),
        "metervolume": number("metervolume"),
        "player": player("bmunitid"),
    })
    return ranges.from_floor(parsed, "settlementdate")


def latest_volumes(raw: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Latest reading of each unit, period and direction, with unit attributes."""
    rows = parse(raw)
    rank = run_rank("settlementruntype")
    best = runs.latest_rank(rows, runs.UNIT_DIRECTION, rank)
    last = runs.keep_last_run(rows, best, runs.UNIT_DIRECTION, rank, distinct=True)
    current = bounded(units.current_units(dictionary, *units.ATTRIBUTES), within=dictionary)
    return last.join(current, "bmunitid", "left")


def embedded_units(volumes: DataFrame) -> DataFrame:
    return volumes.where(F.col("player") == "E_")


def big_demand_rows(raw: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Imports of large transmission-connected sites, each row once."""
    large = dictionary.where(F.col("enapp_class").isin(BIG_DEMAND_CLASSES))
    current = bounded(units.current_units(large, "enapp_class"), within=dictionary)
    rows = parse(raw).where(F.col("importexportindicator") == "I")
    return rows.join(current, "bmunitid").dropDuplicates()


def big_demand_totals(rows: DataFrame) -> DataFrame:
    known = rows.where(all_present(*BIG_DEMAND_KEYS))
    return known.groupBy(*BIG_DEMAND_KEYS).agg((F.sum("metervolume") / 1000).alias("volume_gwh"))


def replicated(volume: Column) -> list[Column]:
    """All volumes of the area tables from one measured volume; a metered unit has no line losses of its own."""
    losses = ["uncorrected_line_loss_gwh", "corrected_line_loss_gwh"]
    return [(F.lit(0.0) if c in losses else volume).alias(c) for c in VOLUMES]


def big_demand(raw: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Large transmission demand of every run, in the shape of the area tables."""
    return big_demand_totals(big_demand_rows(raw, dictionary)).select(
        F.col("settlementdate").alias("date"),
        F.col("settlementruntype").alias("settlement_run"),
        F.lit("T-connected").alias("gsp_area"),
        F.col("settlementperiod").alias("settlement_period"),
        F.lit("H").alias("aggregation_type"),
        F.col("enapp_class").alias("description"),
        F.lit("Non-domestic").alias("sector"),
        actual_estimate("estimateindicator").alias("actual_estimate"),
        peak("settlementperiod").alias("peak"),
        *replicated(F.col("volume_gwh")),
        F.lit(0).cast("bigint").alias("meters_count"),
    )


def big_demand_last_run(demand: DataFrame) -> DataFrame:
    ranked = demand.where(run_rank("settlement_run").isNotNull())
    ranks = {"last_run_flag": run_rank("settlement_run")}
    flagged = runs.flag_last_run_of_totals(ranked, runs.CLASS_PERIOD, ranks)
    return flagged.where("last_run_flag").drop("last_run_flag")

"""Half-hourly metered demand and exports by area (report D0276)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.functions.flags import all_present, in_ranges, lookup, peak, run_rank
from settle.functions.text import compact_date, integer, made_once, number, period, strict, try_compact_date
from settle.operators import factors, measures, runs
from settle.session import bounded, offered
from settle.sources.codes import (
    EXPORT_CLASSES, IMPORT_CLASSES, IMPORT_RUNS, NON_EXPORT_CCC, NON_IMPORT_CCC,
)

IMPORT_KEYS = [
    "date", "file_date", "settlement_run", "gsp_area", "settlement_period",
    "aggregation_type", "description", "sector", "actual_estimate", "peak",
]

EXPORT_KEYS = [
    "date", "settlement_run", "gsp_area", "settlement_period",
    "description", "sector", "actual_estimate", "peak", "ccc",
]

RAW_SUMS = ["a", "h", "m", "c", "meters_count"]


# Fields that a row must not lose without a word.
READABLE = {"zpd": try_compact_date, "pool": try_compact_date, "spx": integer}


def parse(raw: DataFrame) -> DataFrame:
    # Read once, and strict only where the date is used.
    read = made_once(raw.withColumn("_zpd", try_compact_date("zpd")), "_zpd")
    return read.select(
        strict("zpd", F.col("_zpd"), "date", "no known form of date").alias("date"),
        compact_date("pool").alias("file_date"),
        F.col("hdr").alias("settlement_run"),
        F.col("gsp").alias("gsp_area"),
        F.col("ccc").cast("int").alias("ccc"),
        period("spx").alias("settlement_period"),
        *[number(c).alias(c) for c in "ahmc"],
        F.col("ai").alias("meters_count"),
    )


def is_import() -> Column:
    """Class is not an export or non-half-hourly class; no class at all passes."""
    return F.col("ccc").isNull() | ~in_ranges("ccc", NON_IMPORT_CCC)


def is_export() -> Column:
    return F.col("ccc").isNull() | ~in_ranges("ccc", NON_EXPORT_CCC)


def add_class(df: DataFrame, classes: dict) -> DataFrame:
    """Metering description, sector and actual/estimated from the class."""
    parts = ("description", "sector", "actual_estimate")
    return df.withColumns({
        part: lookup({k: v[i] for k, v in classes.items()}, F.col("ccc"))
        for i, part in enumerate(parts)
    })


def class_totals(rows: DataFrame, keys: list[str], classes: dict) -> DataFrame:
    """Distinct rows summed by class. Rows without a class stay, with null keys."""
    shaped = add_class(rows.dropDuplicates(), classes).withColumns({
        "peak": peak("settlement_period"), "aggregation_type": F.lit("H"),
    })
    return shaped.groupBy(*keys).agg(*measures.sums(*RAW_SUMS))


def demand_all_runs(raw: DataFrame, tlm: DataFrame) -> DataFrame:
    """Demand of every run in GWh, with a flag on the latest run.

    All factors are constant within a group, so rows are summed first and the
    multipliers are joined to the totals, which are thousands of times fewer.
    Rows without a class take part in the choice of the run and then drop out.
    """
    rows = parse(raw).where(is_import() & F.col("settlement_run").isin(IMPORT_RUNS))
    totals = class_totals(rows, IMPORT_KEYS, IMPORT_CLASSES)
    ranks = {"last_run_flag": run_rank("settlement_run")}
    flagged = runs.flag_last_run_of_totals(totals, runs.HALF_HOUR, ranks)
    known = flagged.where(all_present(*IMPORT_KEYS))
    joined = factors.join_factor(known, offered(factors.loss_multipliers(tlm), tlm))
    return measures.import_volumes(joined).select(
        *IMPORT_KEYS, "last_run_flag", *measures.VOLUMES, "meters_count"
    )


def last_run(all_runs: DataFrame) -> DataFrame:
    return all_runs.where("last_run_flag").drop("last_run_flag", "file_date")


def exports(raw: DataFrame, tlm: DataFrame) -> DataFrame:
    """Embedded exports of the latest run."""
    rows = parse(raw).where(is_export())
    rank = run_rank("settlement_run")
    best = bounded(runs.latest_rank(rows, runs.HALF_HOUR, rank))
    kept = runs.keep_last_run(rows, best, runs.HALF_HOUR, rank)
    totals = class_totals(kept, EXPORT_KEYS, EXPORT_CLASSES).where(all_present(*EXPORT_KEYS))
    joined = factors.join_factor(totals, offered(factors.loss_multipliers(tlm), tlm))
    return measures.export_volumes(joined).select(
        *EXPORT_KEYS, *measures.VOLUMES, "total_tlm_corrected_consumption_gwh", "meters_count"
    )

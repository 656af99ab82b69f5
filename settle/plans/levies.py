"""Volumes behind capacity-market and renewable levies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.functions import calendar
from settle.functions.flags import all_present, fit_eligible, ro_eligible, scheme_rank
from settle.operators import ranges, runs
from settle.sources.codes import SCHEME_RUNS

SCHEME_COLUMNS = [
    "date", "settlement_run", "gsp_area", "settlement_period",
    "aggregation_type", "description", "sector", "actual_estimate", "peak",
    "uncorrected_consumption_gwh", "uncorrected_line_loss_gwh",
    "total_uncorrected_consumption_gwh",
]


def add_calendar(df: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Financial year, month, year and to-date flags; dates become timestamps."""
    parts = {
        "fy": calendar.fin_year("date"),
        "month-year": calendar.month_start("date").cast("timestamp_ntz"),
        "month": F.month("date"),
        "year": F.year("date"),
    }
    flagged = calendar.add_to_date_flags(df.withColumns(parts), dates=dates)
    return flagged.withColumn("date", F.col("date").cast("timestamp_ntz"))


def cap_mech(gross: DataFrame, holidays: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Gross demand with the flags of the capacity mechanism.

    `dates` may give its dates from a stored table.
    """
    typed = calendar.add_day_type(gross, holidays, "date", "wd", "wd", "nwd")
    return add_calendar(typed.withColumn("flag_cm", calendar.cap_mech("date", "wd")), dates)


def scheme_rows(df: DataFrame, run_codes: list[str]) -> DataFrame:
    """What the schemes read of a table; the runs reach the scan of the raw rows."""
    return df.where(F.col("settlement_run").isin(run_codes)).select(*SCHEME_COLUMNS)


def eligible_runs(rows: DataFrame) -> DataFrame:
    """Rows that may feed either scheme, with their rank where they may."""
    rank = scheme_rank("settlement_run")
    open_to = {
        "_ro": F.when(ro_eligible("date", rank), rank),
        "_fit": F.when(fit_eligible("date", rank), rank),
    }
    either = F.col("_ro").isNotNull() | F.col("_fit").isNotNull()
    return rows.withColumns(open_to).where(either & all_present(*runs.SCHEME))


def chosen_runs(eligible: DataFrame) -> DataFrame:
    """Rows of the last eligible run of either scheme, flagged by scheme.

    Rows are totals: one for each key, run and file.
    """
    ranks = {"last_run_ro": F.col("_ro"), "last_run_fit": F.col("_fit")}
    flagged = runs.flag_last_run_of_totals(eligible, runs.SCHEME, ranks)
    return flagged.where("last_run_ro OR last_run_fit").drop("_ro", "_fit")


def later_rows(profiled: DataFrame, demand: DataFrame) -> DataFrame:
    """Profiled and transmission demand on the dates that both cover."""
    sides = [scheme_rows(df, SCHEME_RUNS) for df in (profiled, demand)]
    shared = ranges.overlap(*[ranges.bounds(df, "date") for df in sides])
    first, second = [ranges.clip(df, "date", shared) for df in sides]
    return first.unionByName(second)


def scheme_sides(half_hourly, profiled, demand) -> tuple[DataFrame, DataFrame]:
    """Half-hourly SF rows, and eligible rows of the rest, on shared dates."""
    fixed = scheme_rows(half_hourly, ["SF"])
    later = later_rows(profiled, demand)
    shared = ranges.overlap(ranges.bounds(fixed, "date"), ranges.bounds(later, "date"))
    return ranges.clip(fixed, "date", shared), eligible_runs(ranges.clip(later, "date", shared))


def scheme_union(fixed: DataFrame, eligible: DataFrame) -> DataFrame:
    """SF rows count for both schemes; of the rest, the chosen runs."""
    flags = {"last_run_ro": F.lit(True), "last_run_fit": F.lit(True)}
    return fixed.withColumns(flags).unionByName(chosen_runs(eligible))


def ro_fit(half_hourly: DataFrame, profiled: DataFrame, demand: DataFrame) -> DataFrame:
    """Volumes for the renewables obligation and the feed-in tariff.

    Every date with an eligible row has a chosen one, so the latest date is
    found without choosing runs.
    """
    fixed, eligible = scheme_sides(half_hourly, profiled, demand)
    dates = fixed.select("date").unionByName(eligible.select("date"))
    return add_calendar(scheme_union(fixed, eligible), dates)

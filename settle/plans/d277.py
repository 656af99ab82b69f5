"""Profiled demand of non-half-hourly meters (report D0277).

The report holds annual figures by profile. All joins are made at day grain;
the growth to half hours comes last and feeds straight into the sum, so
half-hourly rows are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.functions.calendar import add_day_type
from settle.functions.flags import all_present, lookup, peak, run_rank
from settle.functions.text import compact_date, integer, made_once, number, strict, try_compact_date
from settle.operators import factors, measures, ranges, runs
from settle.session import bounded, fits
from settle.sources.codes import PROFILE_SECTOR

MEASURES = list("fghijklm")

REPORT_KEYS = [
    "date", "file_date", "settlement_run", "gsp_area", "profile_class",
    "configuration", "regime", "loss_class", "distributor",
]

TOTAL_KEYS = [
    "date", "file_date", "settlement_run", "settlement_period", "gsp_area", "profile_class",
]

DAY_KEYS = [key for key in TOTAL_KEYS if key != "settlement_period"]

# Rows of these keys are brought together before they grow into half hours. Their
# number is bounded by runs, files, configurations, regimes, loss classes and
# distributors. They are keys of the profile shares too, which are moved to the rows.
PLACE_KEYS = ["date", "gsp_area", "profile_class"]

# Peak follows from the period and sector from the class, so they are no keys.
KEYS = TOTAL_KEYS + ["peak", "sector"]

# Rows of these keys have the same profile in the same periods.
BAND_KEYS = DAY_KEYS + ["configuration", "regime", "first_period", "last_period"]

# Quality -> source of volumes and of the meter count.
QUALITIES = {"Estimate": ("estimate", "estimate_meters"), "Actual": ("advance", "advance_meters")}


# Fields that a row must not lose without a word.
READABLE = {"zpd": try_compact_date, "pool": try_compact_date}


def parse(raw: DataFrame) -> DataFrame:
    # Read once, and strict only where the date is used.
    read = made_once(raw.withColumn("_zpd", try_compact_date("zpd")), "_zpd")
    return read.select(
        strict("zpd", F.col("_zpd"), "date", "no known form of date").alias("date"),
        compact_date("pool").alias("file_date"),
        F.col("hdr").alias("settlement_run"),
        F.col("gsp").alias("gsp_area"),
        integer("a").alias("profile_class"),
        F.col("b").alias("configuration"),
        F.col("c").cast("string").alias("loss_class"),
        F.col("d").alias("distributor"),
        integer("e").alias("regime"),
        *[number(c).alias(c) for c in MEASURES],
    )


def add_sector(df: DataFrame) -> DataFrame:
    return df.withColumn("sector", lookup(PROFILE_SECTOR, F.col("profile_class")))


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows with every field present, each once.

    Dealt once by the keys of the later sums, which then move nothing. Hardly any
    row has a copy in its own part of the report, so none are sought before that.
    """
    known = made_once(df, "file_date").where(all_present(*df.columns))
    return known.repartition(*PLACE_KEYS).dropDuplicates()


def annual_sums(rows: DataFrame) -> DataFrame:
    """Measures summed over rows that share all factors.

    Normally a row stands alone here; where many rows share the keys, they are
    put together before each grows into 50 periods.
    """
    sums = rows.groupBy(*REPORT_KEYS).agg(*measures.sums(*"fghijk"))
    # Half-hourly sums are then made where the half hours are, without a shuffle.
    # Complete rows lie so already.
    return sums.repartition(*PLACE_KEYS)


def classes_in_use(rows: DataFrame) -> DataFrame:
    """Loss classes and months of report rows; a short list, whatever the number of rows."""
    return rows.select("distributor", "loss_class", F.trunc("date", "MM").alias("month")).distinct()


def day_shares(tlm: DataFrame, gcf: DataFrame, pc: DataFrame) -> DataFrame:
    """Profile shares and correction factors of a day."""
    days = factors.day_factors(tlm, gcf)
    return factors.period_shares(factors.day_profiles(pc).join(days.hint("merge"), ["date", "gsp_area"]))


def band_sums(rows: DataFrame, bands: DataFrame) -> DataFrame:
    """Measures summed over rows that share profile and band of periods.

    A loss factor holds for all periods of its band, so line losses are summed as
    `f_lost` and so on; loss classes and distributors then need no half hours of
    their own.
    """
    joined = factors.join_loss_bands(rows, bands).where(F.col("llf").isNotNull())
    lost = [F.sum(F.col(c) * (F.col("llf") - 1)).alias(f"{c}_lost") for c in measures.LOSSY]
    # Moves nothing where the bands were sent around: the rows still lie as `annual_sums` left them.
    return joined.repartition(*PLACE_KEYS).groupBy(*BAND_KEYS).agg(*measures.sums(*"fghijk"), *lost)


def half_hours(rows, tlm, gcf, pc, llf, calendar, used: DataFrame | None = None) -> DataFrame:
    """Complete rows spread over the periods that have all factors.

    `used` may give the classes in use: the list of loss factors has every class
    on every date, many times what a report refers to.
    """
    # Factors are unique by date and area, so a coefficient row stays one row.
    shares = day_shares(tlm, gcf, pc)
    small = fits(shares, pc, factors.PERIODS)
    shares = F.broadcast(shares) if small else shares.hint("merge")
    bands = factors.loss_bands(llf, ranges.bounds(tlm, "settlement_date"))
    if used is not None:
        bands = factors.bands_in_use(bands, used)
    bands = bounded(bands)
    sums = band_sums(add_day_type(rows, calendar, "date", "day_type"), bands)
    if not small:
        # Rows lie by some of the join keys: they stay there, and only the shares move.
        rows.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    joined = sums.join(shares, ["date", "gsp_area", "profile_class", "configuration", "regime"])
    # Wide as they are now, rows are not moved again: this moves nothing where they stayed.
    return factors.expand_periods(joined.repartition(*PLACE_KEYS))


def profile_totals(df: DataFrame) -> DataFrame:
    """Volumes and meter counts by area, class and period.

    Unmetered volume is estimated as well, so it is added to the estimate.
    """
    shaped = measures.profile_volumes(
        df, {"estimate": ["f", "j"], "advance": ["h"]}
    )
    volumes = [
        f"{prefix}{name}{part}_gwh"
        for name in ("estimate", "advance")
        for prefix in ("", "corrected_")
        for part in ("", "_loss")
    ]
    totals = shaped.groupBy(*TOTAL_KEYS).agg(
        *measures.sums(*volumes),
        F.sum(F.col("g") + F.col("k")).alias("estimate_meters"),
        F.sum("i").alias("advance_meters"),
    )
    return add_sector(totals).withColumn("peak", peak("settlement_period"))


def split_quality(df: DataFrame) -> DataFrame:
    """Estimated and actual figures of a row as two rows."""
    sides = [
        F.struct(
            F.lit(quality).alias("data_quality"),
            F.col(f"{name}_gwh").alias("uncorrected_consumption_gwh"),
            F.col(f"{name}_loss_gwh").alias("uncorrected_line_loss_gwh"),
            F.col(f"corrected_{name}_gwh").alias("corrected_consumption_gwh"),
            F.col(f"corrected_{name}_loss_gwh").alias("corrected_line_loss_gwh"),
            F.col(meters).alias("meters_count"),
        )
        for quality, (name, meters) in QUALITIES.items()
    ]
    return df.select(*KEYS, F.inline(F.array(*sides)))


def with_consumption(df: DataFrame) -> DataFrame:
    """Rows whose consumption is not zero; rows without any are left out too."""
    return df.where(F.col("uncorrected_consumption_gwh") != 0)


def in_area_shape(df: DataFrame) -> DataFrame:
    """Columns of the area tables; rows without consumption are left out."""
    total = F.col("corrected_consumption_gwh") + F.col("corrected_line_loss_gwh")
    plain = F.col("uncorrected_consumption_gwh") + F.col("uncorrected_line_loss_gwh")
    return with_consumption(df).select(
        "date", "file_date", "settlement_run", "gsp_area", "settlement_period",
        F.lit("N").alias("aggregation_type"),
        F.col("profile_class").cast("string").alias("description"),
        "sector",
        F.substring("data_quality", 1, 1).alias("actual_estimate"),
        "peak",
        "uncorrected_consumption_gwh", "uncorrected_line_loss_gwh",
        "corrected_consumption_gwh", "corrected_line_loss_gwh",
        total.alias("total_corrected_consumption_gwh"),
        plain.alias("total_uncorrected_consumption_gwh"),
        "meters_count",
    )


def demand(rows, tlm, gcf, pc, llf, calendar) -> DataFrame:
    """Profiled demand in GWh of parsed report rows."""
    annual = annual_sums(complete_rows(add_sector(rows)))
    spread = half_hours(annual, tlm, gcf, pc, llf, calendar, classes_in_use(rows))
    return in_area_shape(split_quality(profile_totals(spread)))


def demand_all_runs(raw, tlm, gcf, pc, llf, calendar) -> DataFrame:
    """Profiled demand of every run, with a flag on the latest run of the day."""
    rows = parse(raw)
    rank = run_rank("settlement_run")
    # Incomplete rows take part in the choice of the run.
    best = bounded(runs.latest_rank(rows, runs.DAY, rank))
    return runs.flag_last_run(demand(rows, tlm, gcf, pc, llf, calendar), best, runs.DAY, rank)


def demand_last_run(raw, tlm, gcf, pc, llf, calendar) -> DataFrame:
    """As `last_run` of all runs, but other runs are not spread to half hours."""
    rows = parse(raw)
    rank = run_rank("settlement_run")
    best = bounded(runs.latest_rank(rows, runs.DAY, rank))
    kept = runs.keep_last_run(rows, best, runs.DAY, rank)
    return demand(kept, tlm, gcf, pc, llf, calendar).drop("file_date")

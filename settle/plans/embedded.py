"""Generation embedded in the distribution networks, by class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.functions.calendar import period_start
from settle.functions.flags import missing_volume
from settle.operators import ranges

PERIOD = ["settlement_date", "settlement_period"]
CLASS = PERIOD + ["enapp_class", "all_notify"]


def export_totals(exports: DataFrame) -> DataFrame:
    """Loss-adjusted exports of all areas by period."""
    totals = exports.groupBy(
        F.col("date").alias("settlement_date"), "settlement_period"
    ).agg(F.sum("total_tlm_corrected_consumption_gwh").alias("p315_volume_gwh"))
    known = totals.where(F.col("settlement_period").isNotNull())
    return ranges.from_floor(known, "settlement_date")


def unit_exports(volumes: DataFrame) -> DataFrame:
    """Exports by class, notification and player; an unknown notification is false."""
    rows = ranges.from_floor(volumes, "settlementdate").where(
        (F.col("importexportindicator") == "export")
        & F.col("settlementperiod").isNotNull() & F.col("enapp_class").isNotNull()
    )
    adjusted = F.col("bmunitmeteredvolume") * F.col("transmissionlossmultiplier")
    return rows.groupBy(
        F.col("settlementdate").alias("settlement_date"),
        F.col("settlementperiod").alias("settlement_period"),
        "enapp_class",
        F.coalesce("all_notify", F.lit(False)).alias("all_notify"),
        "player",
    ).agg(F.sum(adjusted).alias("mwh"))


def add_classifications(df: DataFrame) -> DataFrame:
    """One row for each classification that applies; a unit may have two."""
    sva = F.startswith("enapp_class", F.lit("SVA"))
    player = F.col("player")
    labels = F.array(
        F.when(sva, "sva_bmu"),
        F.when(player == "E_", "embedded_bmu"),
        F.when(player == "C_", "supplier_cfd"),
        F.when((player == "2_") & ~sva, "supplier_embedded_no_cfd"),
    )
    return df.withColumn("classification", F.explode(F.array_compact(labels)))


def classified(volumes: DataFrame) -> DataFrame:
    """Embedded exports in GWh by class and classification.

    Rows are summed by player first, so labels multiply totals, not readings.
    """
    return (
        add_classifications(unit_exports(volumes))
        .groupBy(*CLASS, "classification")
        .agg((F.sum("mwh") / 1000).alias("volume_gwh"))
    )


def complement(totals: DataFrame, known: DataFrame) -> DataFrame:
    """Metered area exports that no unit accounts for."""
    explained = known.groupBy(*PERIOD).agg(F.sum("volume_gwh").alias("_known"))
    return totals.join(explained, PERIOD, "left").select(
        *PERIOD,
        F.lit("p315_complement").alias("enapp_class"),
        F.lit(False).alias("all_notify"),
        F.lit("metered_gsp_exports").alias("classification"),
        missing_volume(F.col("p315_volume_gwh"), F.col("_known")).alias("volume_gwh"),
    )


def embedded_rows(exports: DataFrame, volumes: DataFrame) -> DataFrame:
    known = classified(volumes)
    return known.unionByName(complement(export_totals(exports), known))


def embedded_generation(exports: DataFrame, volumes: DataFrame) -> DataFrame:
    """All classes and the complement, on dates that both inputs cover.

    `volumes` is the settlement report of the latest run: with all runs, each
    reading would count several times.
    """
    shared = ranges.overlap(
        ranges.bounds(ranges.from_floor(exports, "date"), "date"),
        ranges.bounds(volumes, "settlementdate"),
    )
    rows = ranges.clip(embedded_rows(exports, volumes), "settlement_date", shared)
    start = period_start("settlement_date", "settlement_period")
    return rows.withColumn("settlement_datetime", start)

"""Dictionary of balancing units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.functions.flags import lookup
from settle.functions.text import any_date, player
from settle.operators.runs import last_version
from settle.sources.codes import (
    CLASS_FLAGS, DICTIONARY_COLUMNS, FLAG_PLAYERS, NOTIFY_PLAYERS, UNIT_CATEGORY,
)
from settle.sources.names import with_station_names, with_type_names
from settle.sources.xml import parse_unit_xml

# Payload sources and the dictionary column that their type code fills.
TYPE_SOURCES = {"fuel": "neta_type", "grid": "ngc_type", "station": "power_station_id"}

ATTRIBUTES = [
    "bsc_party", "enapp_name", "ngc_name", "ngc_bmu_id",
    "ngc_bmu_flag", "enapp_class", "all_notify",
]


def capacity_means(periods: DataFrame) -> DataFrame:
    """Mean capacities of a unit over the periods of each payload type."""
    return periods.groupBy("source", "type_code", "bmu_id").agg(
        F.avg("gc").alias("generation_capacity"), F.avg("dc").alias("demand_capacity")
    )


def known_types(means: DataFrame) -> DataFrame:
    """Without the grid type 'NA' and class rows that lack a capacity."""
    no_type = (F.col("source") == "grid") & (F.col("type_code") == "NA")
    bare = F.col("generation_capacity").isNull() | F.col("demand_capacity").isNull()
    return means.where(~(no_type | ((F.col("source") == "class") & bare)))


def unit_sources(means: DataFrame) -> DataFrame:
    """One row a unit: its types, its class flags and its mean capacities.

    A capacity is the mean over all payload types that list the unit. Of
    several types that one source gives a unit, the last by code counts. One
    aggregate does the work of a join per source.
    """
    types = [
        F.max(F.when(F.col("source") == source, F.col("type_code"))).alias(column)
        for source, column in TYPE_SOURCES.items()
    ]
    in_class = F.col("source") == "class"
    flags = [
        F.max(F.when(in_class & (F.col("type_code") == code), True)).alias(column)
        for code, column in CLASS_FLAGS.items()
    ]
    return means.groupBy("bmu_id").agg(
        *types, *flags,
        F.avg("generation_capacity").alias("generation_capacity"),
        F.avg("demand_capacity").alias("demand_capacity"),
    )


def unit_status(df: DataFrame) -> DataFrame:
    """Open end date, presence of a grid id, player."""
    return df.withColumns({
        "currently_active": F.col("effective_to_date").isNull(),
        "ngc_bmu_flag": F.col("ngc_bmu_id").isNotNull(),
        "player": player("bmu_id"),
    })


def source_dictionary(
    payloads: DataFrame, parties: DataFrame, names: DataFrame, stations: DataFrame
) -> DataFrame:
    """Unit dictionary from the capacity payloads, party list and list of units.

    An effective-to date is open where the text is missing; a date in no known
    form fails the job.
    """
    sources = unit_sources(known_types(capacity_means(parse_unit_xml(payloads))))
    base = parties.select(
        F.col("bmunit").alias("bmu_id"),
        F.col("bscparty").alias("bsc_party"),
        any_date("effectivefromdate").alias("effective_from_date"),
        any_date("effectivetodate").alias("effective_to_date"),
    )
    # A unit listed twice keeps one of its records whole: the last by name.
    record = F.struct(
        F.col("name").alias("enapp_name"), F.col("fueltype").alias("enapp_class"), F.col("ngcbmunitid").alias("ngc_bmu_id")
    )
    records = names.groupBy(F.col("bmunitid").alias("bmu_id")).agg(F.max(record).alias("record")).select("bmu_id", "record.*")
    joined = base.join(sources, "bmu_id", "left").join(records, "bmu_id", "left")
    named = with_station_names(with_type_names(joined), stations)
    return last_version(unit_status(named)).select(*DICTIONARY_COLUMNS)


def join_registered(dictionary: DataFrame, registered: DataFrame) -> DataFrame:
    """Add notification flag of the registered unit and whether there is one."""
    side = registered.where(F.col("bm_unit_id").isNotNull()).groupBy("bm_unit_id").agg(
        F.max("fpn_flag").alias("fpn_flag")
    )
    return (
        dictionary.join(side, F.col("bmu_id") == F.col("bm_unit_id"), "left")
        .withColumn("matched", F.col("bm_unit_id").isNotNull())
        .drop("bm_unit_id")
    )


def fill_unit_flags(df: DataFrame) -> DataFrame:
    """Fill open class flags from the player."""
    return df.withColumns({
        flag: F.coalesce(flag, F.col("player").isin(players), F.lit(False))
        for flag, players in FLAG_PLAYERS.items()
    })


def derive_notify(df: DataFrame) -> DataFrame:
    """Notification flags of registered units whose notification is not known."""
    open_rows = F.col("matched") & F.col("all_notify").isNull()
    notifies = F.coalesce(F.col("fpn_flag") != "F", F.lit(True))
    made = {
        flag: F.when(open_rows, notifies & F.coalesce(F.col("player").isin(players), F.lit(False)))
        .otherwise(F.col(flag))
        for flag, players in NOTIFY_PLAYERS.items()
    }
    made["all_notify"] = F.when(open_rows, notifies).otherwise(F.col("all_notify"))
    return df.withColumns(made)


def unit_dictionary(dictionary: DataFrame, registered: DataFrame) -> DataFrame:
    """Dictionary with open flags filled from registered units."""
    steps = [fill_unit_flags, derive_notify]
    merged = reduce(lambda df, step: step(df), steps, join_registered(dictionary, registered))
    return merged.select(*dictionary.columns)


def current_units(dictionary: DataFrame, *columns: str) -> DataFrame:
    """Current version of each unit, keyed as in the volume reports."""
    return (
        dictionary.where("last_flag")
        .select(F.col("bmu_id").alias("bmunitid"), *columns)
        .dropDuplicates()
    )


def unit_categories(units: DataFrame) -> DataFrame:
    """Category of each unit's class; a unit without class counts as NONE."""
    known = F.coalesce("enapp_class", F.lit("NONE"))
    return units.withColumn("enapp_category", lookup(UNIT_CATEGORY, known))


def join_categories(df: DataFrame, units: DataFrame) -> DataFrame:
    """Unit attributes and category; a unit not listed is of class NONE."""
    listed = F.col("enapp_class").isNotNull()
    joined = df.join(units, "bmunitid", "left")
    return joined.withColumns({
        "enapp_category": F.when(listed, F.col("enapp_category")).otherwise(UNIT_CATEGORY["NONE"]),
        "enapp_class": F.coalesce("enapp_class", F.lit("NONE")),
    })

"""Display names of unit type codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.functions.flags import lookup
from settle.sources.codes import FUEL_NAMES, GRID_NAMES


def with_type_names(df: DataFrame) -> DataFrame:
    """Names of fuel type and grid type; an unknown code has no name."""
    return df.withColumns({
        "neta_name": lookup(FUEL_NAMES, F.col("neta_type")),
        "ngc_name": lookup(GRID_NAMES, F.col("ngc_type")),
    })


def with_station_names(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Name of the power station, from a table (`power_station_id`, `power_station_name`)."""
    names = stations.groupBy("power_station_id").agg(
        F.max("power_station_name").alias("power_station_name")
    )
    return df.join(names, "power_station_id", "left")

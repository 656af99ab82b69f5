"""Unit payloads in XML: capacities, the party list and the list of units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.functions.text import compact_date
from settle.schemas import UNIT_PAYLOAD


# Where the parser puts the text of a payload that it cannot read.
CORRUPT = "_malformed"


def _parsed(payload: str, schema: str) -> Column:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_xml(payload, f"{schema}, {CORRUPT} string", options)


def _malformed(payload: str, parsed: Column) -> Column:
    """Text that is no XML, is cut off, or goes on after its last element; a null payload is none."""
    ends = F.rtrim(F.regexp_replace(payload, r"\s+$", "")).endswith(">")
    return F.col(payload).isNotNull() & (parsed[CORRUPT].isNotNull() | ~ends)


def _read(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """`_read` beside the other columns; a malformed payload fails the job, as units would be lost without a word."""
    others = [c for c in df.columns if c != payload]
    made = df.select(*others, payload, _parsed(payload, schema).alias("_read"))
    wrong = F.raise_error(F.concat(F.lit("malformed payload: "), F.substring(payload, 1, 120)))
    checked = F.when(_malformed(payload, F.col("_read")), wrong.cast(made.schema["_read"].dataType)).otherwise(F.col("_read"))
    return made.select(*others, checked.alias("_read"))


def malformed_payloads(df: DataFrame, schema: str = UNIT_PAYLOAD, payload: str = "payload") -> DataFrame:
    """The rows whose payload cannot be read; the others can be parsed once these are set aside."""
    made = df.withColumn("_read", _parsed(payload, schema))
    return made.where(_malformed(payload, F.col("_read"))).drop("_read")


def readable_payloads(df: DataFrame, schema: str = UNIT_PAYLOAD, payload: str = "payload") -> DataFrame:
    """The rows whose payload can be read or is null."""
    made = df.withColumn("_read", _parsed(payload, schema))
    return made.where(~F.coalesce(_malformed(payload, F.col("_read")), F.lit(False))).drop("_read")


def parse_unit_xml(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each unit and period of a payload, with its two capacities.

    A day without units gives no rows; a malformed payload fails the job.
    """
    others = [c for c in df.columns if c != payload]
    units = _read(df, payload, UNIT_PAYLOAD).select(
        *others,
        compact_date("_read.settlementdate._settlementdate").alias("settlement_date"),
        F.explode("_read.settlementdate.bmunit").alias("_unit"),
    )
    return units.select(
        *others, "settlement_date",
        F.col("_unit._bmunitid").alias("bmu_id"),
        F.explode("_unit.settlementperiod").alias("_period"),
    ).select(
        *others, "settlement_date", "bmu_id",
        F.col("_period._settlementperiod").alias("settlement_period"),
        F.col("_period._gc").alias("gc"),
        F.col("_period._dc").alias("dc"),
    )


def _parse_list(df: DataFrame, payload: str, element: str, attributes: list[str]) -> DataFrame:
    """One row for each element of a payload, its attributes as text columns."""
    fields = ", ".join(f"_{a}: string" for a in attributes)
    read = _read(df.select(payload), payload, f"{element} array<struct<{fields}>>")
    each = read.select(F.explode(f"_read.{element}").alias("_item"))
    return each.select(*[F.col(f"_item._{a}").alias(a) for a in attributes])


def parse_party_list(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Party and period of validity of each unit version."""
    columns = ["bmunit", "bscparty", "effectivefromdate", "effectivetodate"]
    return _parse_list(df, payload, "bmunitforbscparty", columns)


def parse_unit_list(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Name, fuel type and grid id of each unit."""
    return _parse_list(df, payload, "bmunit", ["bmunitid", "name", "fueltype", "ngcbmunitid"])

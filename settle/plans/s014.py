"""Unit settlement report (S0142)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.functions.flags import import_export, run_rank
from settle.functions.text import date_of, integer, number, period, player, try_date
from settle.operators import runs
from settle.plans import units
from settle.session import bounded

UNUSED = ["dataflowid", "inserteddate"]

NUMBERS = [
    "periodfpn", "bmunitmeteredvolume", "transmissionlossmultiplier",
    "bmunitapplicablebalancingservicesvolume",
]


# Fields that a row must not lose without a word.
READABLE = {"settlementdate": try_date, "settlementperiod": integer}


def parse(raw: DataFrame) -> DataFrame:
    parsed = {c: number(c) for c in NUMBERS}
    parsed["settlementdate"] = date_of(raw, "settlementdate")
    parsed["settlementperiod"] = period("settlementperiod")
    return raw.drop(*UNUSED).withColumns(parsed)


def add_unit_columns(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    current = units.unit_categories(units.current_units(dictionary, *units.ATTRIBUTES))
    return units.join_categories(rows, bounded(current, within=dictionary)).withColumns({
        "importexportindicator": import_export("bmunitmeteredvolume"),
        "player": player("bmunitid"),
    })


def volumes_all_runs(raw: DataFrame, dictionary: DataFrame) -> DataFrame:
    return add_unit_columns(parse(raw), dictionary)


def last_run_rows(raw: DataFrame) -> DataFrame:
    """Distinct rows of the latest run of each unit and period."""
    rows = parse(raw)
    rank = run_rank("settlementruntype")
    best = runs.latest_rank(rows, runs.UNIT_PERIOD, rank)
    return runs.keep_last_run(rows, best, runs.UNIT_PERIOD, rank, distinct=True)


def volumes_last_run(raw: DataFrame, dictionary: DataFrame) -> DataFrame:
    return add_unit_columns(last_run_rows(raw), dictionary)

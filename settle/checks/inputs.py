"""Flow results that several registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.functions.flags import all_present
from settle.operators.runs import last_version
from settle.plans import c042, d276, d277, gross, levies, s014, units
from settle.session import fresh_path, stage
from settle.sources import xml
from settle.sources.codes import SCHEME_RUNS
from settle.sources.holidays import working_calendar


def holidays(t) -> DataFrame:
    return working_calendar(t.raw_holiday)


def unit_dim(t) -> DataFrame:
    """Unit versions with status and a flag on the current one."""
    return last_version(units.unit_status(t.raw_bmu))


def d276_all(t) -> DataFrame:
    return d276.demand_all_runs(t.raw_d276, t.tlm_rows)


def d276_hh(t) -> DataFrame:
    return d276.last_run(d276_all(t))


def exports(t) -> DataFrame:
    return d276.exports(t.raw_d276, t.tlm_rows)


def d277_all(t) -> DataFrame:
    return d277.demand_all_runs(
        t.raw_d277, t.tlm_rows, t.raw_gcf, t.raw_pc, t.raw_llf, holidays(t)
    )


def d277_hh(t) -> DataFrame:
    return d277.demand_last_run(
        t.raw_d277, t.tlm_rows, t.raw_gcf, t.raw_pc, t.raw_llf, holidays(t)
    )


def d277_half_hours(t) -> DataFrame:
    rows = d277.add_sector(d277.parse(t.raw_d277))
    sums = d277.annual_sums(d277.complete_rows(rows))
    # A date is read only of rows that have the other fields, as in the sums.
    others = [c for c in rows.columns if c not in ("date", "file_date")]
    used = d277.classes_in_use(rows.where(all_present(*others)))
    return d277.half_hours(sums, t.tlm_rows, t.raw_gcf, t.raw_pc, t.raw_llf, holidays(t), used)


def big_demand(t) -> DataFrame:
    return c042.big_demand(t.raw_c042, unit_dim(t))


def big_demand_last(t) -> DataFrame:
    return c042.big_demand_last_run(big_demand(t))


def s014_last(t) -> DataFrame:
    return s014.volumes_last_run(t.raw_s014, unit_dim(t))


def p315_hh(t) -> DataFrame:
    return gross.p315(d276_hh(t), d277_hh(t))


def gross_demand(t) -> DataFrame:
    """The area table is saved first: its dates and its rows are both read."""
    return gross.gross_demand(stage(p315_hh(t), "p315_hh"), big_demand_last(t))


def gross_daily(t) -> DataFrame:
    return gross.gross_daily(p315_hh(t), big_demand_last(t))


def cap_mech(t) -> DataFrame:
    """Only the area table is stored; the transmission demand lies on its dates."""
    area = stage(p315_hh(t), "p315_hh")
    demand = gross.gross_demand(area, big_demand_last(t))
    return levies.cap_mech(demand, holidays(t), area.select("date"))


def scheme_inputs(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored for the passes over their dates, with the runs and columns that the schemes read."""
    return (
        stage(levies.scheme_rows(d276_all(t), ["SF"]), "d276_scheme"),
        stage(levies.scheme_rows(d277_all(t), SCHEME_RUNS), "d277_scheme"),
        stage(levies.scheme_rows(big_demand(t), SCHEME_RUNS), "big_demand_scheme"),
    )


def embedded_inputs(t) -> tuple[DataFrame, DataFrame]:
    return stage(exports(t), "embedded_sva"), stage(s014_last(t), "s014_hh")


def source_units(t) -> DataFrame:
    parties, names = xml.parse_party_list(t.raw_party_xml), xml.parse_unit_list(t.raw_names_xml)
    return units.source_dictionary(t.raw_unit_xml, parties, names, t.raw_station)


def fresh_schema(spark) -> str:
    """A new catalog schema whose tables lie in the work folder."""
    path = fresh_path(spark, "schema")
    name = "settle_" + path[-32:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def land_csv(df: DataFrame, name: str, other=None) -> str:
    """Save as CSV files in folders below a fresh one; the path of the upper.

    Half of the rows go to files of another layout: columns the other way
    round, one more among them whose name holds a comma, and what `other` makes of
    their values. Their folder's name holds a space and a percent sign.
    """
    path = fresh_path(df.sparkSession, name)
    usual = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0
    df.where(usual).write.option("header", True).csv(f"{path}/landed")
    changed = df.where(~usual).withColumns(other or {})
    columns = df.columns[::-1]
    changed.withColumn("Remark, if any", F.lit("as received, unchecked")).select(
        *columns[:1], "`Remark, if any`", *columns[1:]
    ).write.option("header", True).csv(f"{path}/other 100%20/deeper")
    return path


def land_lines(df: DataFrame, top: list[str], path: str) -> None:
    """Save as one text file in a folder, CSV below the lines `top`."""
    rows = df.select(F.lit(len(top)).alias("n"), F.to_csv(F.struct(*df.columns)).alias("value"))
    above = df.sparkSession.createDataFrame(list(enumerate(top)), "n int, value string")
    whole = above.unionByName(rows).repartition(1).sortWithinPartitions("n")
    whole.select("value").write.text(path)

"""From landed files and report tables to the output tables.

Each step reads saved tables and saves its own, so a flow is computed once and
whatever follows reads the result. Tables live below one shared folder.

Report tables expected there: `p315` (D0276), `p315_p277` (D0277), `p114_c0421`
and `p114_s01421`; also `holidays`, and for the unit dictionary the landed
`unit_payloads`, `unit_parties`, `unit_names` (XML payloads all three) and
`stations`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from settle.operators import measures, rejects
from settle.plans import c042, d276, d277, embedded, gross, levies, s014, units
from settle.session import configure
from settle.sources import files, xml
from settle.sources.holidays import working_calendar
from settle.sources.tables import scan_table, sink_table


@dataclass
class Store:
    """Saved tables below one folder, or in a catalog schema where no folder is given."""

    spark: SparkSession
    folder: str | None = None
    schema: str = "default"

    def place(self, name: str) -> str:
        return f"{self.folder}/{name}" if self.folder else f"{self.schema}.{name}"

    def read(self, name: str) -> DataFrame:
        return scan_table(self.spark, self.place(name))

    def save(self, df: DataFrame, name: str, by: str | None = None) -> None:
        sink_table(df, self.place(name), "overwrite", [by] if by else None)


def market_tables(store: Store, landed: dict[str, str]) -> None:
    """Reference factors from folders of landed CSV files: tlm, gcf, llf, pc."""
    loaders = {
        "tlm": files.load_tlm, "gcf": files.load_gcf, "llf": files.load_llf, "pc": files.load_pc,
    }
    for name, load in loaders.items():
        store.save(load(store.spark, landed[name]), name)


def unit_tables(store: Store, bm_units_folder: str) -> None:
    """Registered units, the dictionary from payloads, and the merged dictionary."""
    store.save(files.load_bm_units(store.spark, bm_units_folder), "bm_units")
    parties = xml.parse_party_list(store.read("unit_parties"))
    names = xml.parse_unit_list(store.read("unit_names"))
    made = units.source_dictionary(store.read("unit_payloads"), parties, names, store.read("stations"))
    store.save(made, "source_dictionary")
    merged = units.unit_dictionary(store.read("source_dictionary"), store.read("bm_units"))
    store.save(merged, "bmu_dictionary")


# Report table -> its fields that must be readable.
REPORTS = {
    "p315": d276.READABLE, "p315_p277": d277.READABLE, "p114_c0421": c042.READABLE, "p114_s01421": s014.READABLE,
}


def admitted_rows(store: Store, most: int) -> dict[str, DataFrame]:
    """Report rows that can be read; the others are saved as `<report>_rejects`, up to `most` of each report."""
    made = {}
    for name, fields in REPORTS.items():
        store.save(rejects.rejected(store.read(name), fields), f"{name}_rejects")
        rejects.bound(store.read(f"{name}_rejects"), fields, most, name)
        made[name] = rejects.admitted(store.read(name), fields)
    return made


def report_tables(store: Store, most_rejects: int = 0) -> None:
    """Half-hourly tables of the four reports."""
    reports = admitted_rows(store, most_rejects)
    tlm, dictionary = store.read("tlm"), store.read("bmu_dictionary")
    calendar = working_calendar(store.read("holidays"))
    factors = [store.read(n) for n in ("tlm", "gcf", "pc", "llf")]
    store.save(d276.demand_all_runs(reports["p315"], tlm), "d276_hh_all_runs", "date")
    store.save(d276.exports(reports["p315"], tlm), "p315_embedded_sva", "date")
    profiled = d277.demand_all_runs(reports["p315_p277"], *factors, calendar)
    store.save(profiled, "d277_hh_all_runs", "date")
    for report in ("d276", "d277"):
        store.save(d276.last_run(store.read(f"{report}_hh_all_runs")), f"{report}_hh", "date")
        store.save(measures.day_totals(store.read(f"{report}_hh")), f"{report}_daily")
        store.save(measures.peak_totals(store.read(f"{report}_hh")), f"{report}_peak")
    store.save(c042.latest_volumes(reports["p114_c0421"], dictionary), "p114_c042", "settlementdate")
    store.save(c042.embedded_units(store.read("p114_c042")), "p114_embedded_cva")
    store.save(c042.big_demand(reports["p114_c0421"], dictionary), "p114_big_demand_all")
    store.save(c042.big_demand_last_run(store.read("p114_big_demand_all")), "p114_big_demand_lr")
    readings = reports["p114_s01421"]
    store.save(s014.volumes_all_runs(readings, dictionary), "p114_s014_hh_all", "settlementdate")
    store.save(s014.volumes_last_run(readings, dictionary), "p114_s014_hh", "settlementdate")


def output_tables(store: Store) -> None:
    """Area demand, gross demand, levy volumes and embedded generation."""
    for kind in ("hh_all_runs", "hh", "daily", "peak"):
        both = gross.p315(store.read(f"d276_{kind}"), store.read(f"d277_{kind}"))
        store.save(both, f"p315_{kind}", "date" if kind.startswith("hh") else None)
    gross_hh = gross.gross_demand(store.read("p315_hh"), store.read("p114_big_demand_lr"))
    store.save(gross_hh, "gross_demand_hh", "date")
    daily = gross.gross_daily(store.read("p315_hh"), store.read("p114_big_demand_lr"))
    store.save(daily, "gross_demand_daily")
    calendar = working_calendar(store.read("holidays"))
    dates = store.read("p315_hh").select("date")
    store.save(levies.cap_mech(store.read("gross_demand_hh"), calendar, dates), "cfd_capmech")
    sides = [store.read(n) for n in ("d276_hh_all_runs", "d277_hh_all_runs", "p114_big_demand_all")]
    store.save(levies.ro_fit(*sides), "ro_fit")
    generation = embedded.embedded_generation(
        store.read("p315_embedded_sva"), store.read("p114_s014_hh")
    )
    store.save(generation, "embedded_generation", "settlement_date")


def run(spark: SparkSession, folder: str, landed: dict[str, str], most_rejects: int = 0) -> None:
    """All steps; `landed` names the folders of tlm, gcf, llf, pc and bm_units.

    A report may have up to `most_rejects` rows whose date or period cannot be read.
    """
    store = Store(configure(spark), folder)
    market_tables(store, landed)
    unit_tables(store, landed["bm_units"])
    report_tables(store, most_rejects)
    output_tables(store)

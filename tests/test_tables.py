"""The whole chain from landed files to output tables."""

from settle.checks import q_sources
from settle.checks.registry import Inputs
from settle.checks.inputs import gross_daily, land_csv
from settle.plans import tables
from settle.session import fresh_path
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"

TABLES = {
    "p315": "raw_d276", "p315_p277": "raw_d277", "p114_c0421": "raw_c042", "p114_s01421": "raw_s014",
    "holidays": "raw_holiday", "unit_payloads": "raw_unit_xml", "unit_parties": "raw_party_xml",
    "unit_names": "raw_names_xml", "stations": "raw_station",
}


def test_all_tables_from_landed_files(spark):
    t = Inputs(spark, FOLDER)
    folder = fresh_path(spark, "tables")
    for name, view in TABLES.items():
        getattr(t, view).write.parquet(f"{folder}/{name}")
    pc = t.raw_pc
    landed = {
        "tlm": q_sources.land_tlm(t), "gcf": q_sources.land_gcf(t), "llf": q_sources.land_llf(t),
        "pc": land_csv(pc.toDF(*[c.upper() for c in pc.columns]), "pc"),
        "bm_units": q_sources.land_units(t),
    }
    tables.run(spark, folder, landed)
    store = tables.Store(spark, folder)

    area = store.read("p315_hh")
    assert area.count() == store.read("d276_hh").count() + store.read("d277_hh").count()
    for name in ("cfd_capmech", "ro_fit", "embedded_generation", "p114_embedded_cva", "p315_peak"):
        assert store.read(name).count() > 0, name

    keys = ["date", "gsp_area", "aggregation_type", "description"]
    total = F.round(F.sum("total_corrected_consumption_gwh"), 6).alias("x")
    saved = store.read("gross_demand_daily").where("gsp_area <> 'T-connected'").groupBy(*keys).agg(total)
    direct = gross_daily(t).where("gsp_area <> 'T-connected'").groupBy(*keys).agg(total)
    assert {tuple(r) for r in saved.collect()} == {tuple(r) for r in direct.collect()}

"""Queries over whole flows."""

from functools import reduce

from pyspark.sql import functions as F

from settle.checks import inputs
from settle.checks.q_joins import C042_SPEC
from settle.checks.q_totals import ALL_SPEC, CLASS_SPEC, DAY_SPEC, EXPORT_SPEC, HH_SPEC, SCHEME_SPEC
from settle.checks.registry import query
from settle.operators import measures
from settle.plans import c042, d276, embedded, gross, levies, s014, units
from settle.sources.codes import DICTIONARY_COLUMNS

CALENDAR = "fy month-year:t month year ytd fytd"
S014_SPEC = (
    "bmunitid settlementdate:d settlementruntype settlementperiod tradingunitname periodfpn:f"
    " bmunitmeteredvolume:f transmissionlossmultiplier:f bmunitapplicablebalancingservicesvolume:f"
    f" {' '.join(units.ATTRIBUTES)} importexportindicator player enapp_category"
)


@query("flow_d276", ALL_SPEC, "SELECT * FROM d276_all_runs")
def flow_d276(t):
    return inputs.d276_all(t)


@query("flow_d276_last", HH_SPEC, "SELECT * FROM d276_hh")
def flow_d276_last(t):
    return inputs.d276_hh(t)


@query("flow_d276_exports", EXPORT_SPEC, "SELECT * FROM d276_exports")
def flow_d276_exports(t):
    return inputs.exports(t)


@query("flow_d277", ALL_SPEC, "SELECT * FROM d277_all_runs")
def flow_d277(t):
    return inputs.d277_all(t)


@query("flow_d277_last", HH_SPEC, "SELECT * FROM d277_hh")
def flow_d277_last(t):
    return inputs.d277_hh(t)


@query("flow_c042", C042_SPEC, "SELECT * FROM c042_last")
def flow_c042(t):
    return c042.latest_volumes(t.raw_c042, inputs.unit_dim(t))


@query("flow_big_demand", HH_SPEC, "SELECT * FROM big_demand")
def flow_big_demand(t):
    return inputs.big_demand(t)


@query("flow_big_demand_last", HH_SPEC, "SELECT * FROM big_demand_last")
def flow_big_demand_last(t):
    return inputs.big_demand_last(t)


@query("flow_s014", S014_SPEC, "SELECT * FROM s014_all")
def flow_s014(t):
    return s014.volumes_all_runs(t.raw_s014, inputs.unit_dim(t))


@query("flow_s014_last", S014_SPEC, "SELECT * FROM s014_last")
def flow_s014_last(t):
    return inputs.s014_last(t)


KINDS = {"hh_all_runs": "p315_all_runs", "hh": "p315_hh", "daily": "p315_daily", "peak": "p315_peak"}


@query(
    "flow_p315",
    f"kind {ALL_SPEC}",
    " UNION ALL BY NAME ".join(f"SELECT '{kind}' AS kind, * FROM {step}" for kind, step in KINDS.items()),
)
def flow_p315(t):
    """All four tables of the flow, each row with the name of its table."""
    half_hourly, profiled = inputs.d276_all(t), inputs.d277_all(t)
    latest = d276.last_run(half_hourly), d276.last_run(profiled)
    tables = {
        "hh_all_runs": (half_hourly, profiled),
        "hh": latest,
        "daily": [measures.day_totals(df) for df in latest],
        "peak": [measures.peak_totals(df) for df in latest],
    }
    named = [gross.p315(*both).withColumn("kind", F.lit(kind)) for kind, both in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@query("flow_gross_demand", HH_SPEC, "SELECT * FROM gross_demand_hh")
def flow_gross_demand(t):
    return inputs.gross_demand(t)


@query("flow_gross_daily", DAY_SPEC, "SELECT * FROM gross_demand_daily")
def flow_gross_daily(t):
    return inputs.gross_daily(t)


@query(
    "flow_cap_mech",
    f"{HH_SPEC.replace('date:d', 'date:t', 1)} wd flag_cm {CALENDAR}",
    "SELECT * FROM cap_mech_rows",
)
def flow_cap_mech(t):
    return inputs.cap_mech(t)


@query(
    "flow_ro_fit",
    f"{SCHEME_SPEC.replace('date:d', 'date:t', 1)} last_run_ro last_run_fit {CALENDAR}",
    "SELECT * FROM ro_fit_calendar",
)
def flow_ro_fit(t):
    return levies.ro_fit(*inputs.scheme_inputs(t))


@query("flow_embedded", f"{CLASS_SPEC} settlement_datetime:t", "SELECT * FROM embedded_flow")
def flow_embedded(t):
    return embedded.embedded_generation(*inputs.embedded_inputs(t))


def _dictionary_spec() -> str:
    kinds = {
        "effective_from_date": ":d", "effective_to_date": ":d",
        "generation_capacity": ":f", "demand_capacity": ":f",
    }
    return " ".join(c + kinds.get(c, "") for c in DICTIONARY_COLUMNS)


@query("flow_unit_sources", _dictionary_spec(), "SELECT * FROM source_units")
def flow_unit_sources(t):
    return inputs.source_units(t)


@query("flow_unit_dictionary", _dictionary_spec(), "SELECT * FROM merged_units")
def flow_unit_dictionary(t):
    return units.unit_dictionary(inputs.source_units(t), t.raw_bm_units)

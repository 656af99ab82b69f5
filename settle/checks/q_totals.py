"""Queries over aggregates and unions."""

from pyspark.sql import functions as F

from settle.checks import inputs
from settle.checks.q_joins import means
from settle.checks.q_rows import MEANS
from settle.checks.registry import query
from settle.checks.steps import NOT_EXPORT
from settle.checks.steps import peak as peak_sql
from settle.operators import measures, ranges
from settle.plans import c042, d276, d277, embedded, gross, levies
from settle.sources.codes import EXPORT_CLASSES, IMPORT_CLASSES, IMPORT_RUNS
from settle.sources.xml import parse_unit_xml

VOLUME_SPEC = " ".join(f"{c}:f" for c in measures.VOLUMES)
DAY_SPEC = (
    "date:d settlement_run gsp_area aggregation_type description sector actual_estimate"
    f" {VOLUME_SPEC} meters_count:f"
)
HH_SPEC = DAY_SPEC.replace("aggregation_type", "aggregation_type settlement_period peak")
ALL_SPEC = HH_SPEC.replace("settlement_run", "file_date:d last_run_flag settlement_run")
EXPORT_SPEC = (
    "date:d settlement_run gsp_area settlement_period description sector actual_estimate peak ccc"
    f" {VOLUME_SPEC} total_tlm_corrected_consumption_gwh:f meters_count:f"
)


RAW_SUMS = ", ".join(f"sum({c}) AS {c}" for c in "ahmc") + ", CAST(sum(meters_count) AS BIGINT) AS meters_count"
RAW_SPEC = " ".join(f"{c}:f" for c in "ahmc") + " meters_count"


@query(
    "agg_d276_hh",
    "date:d file_date:d settlement_run gsp_area settlement_period aggregation_type description sector actual_estimate"
    f" peak {RAW_SPEC}",
    f"""SELECT date, file_date, settlement_run, gsp_area, settlement_period, 'H' AS aggregation_type, description, sector,
    actual_estimate, {peak_sql('settlement_period')} AS peak, {RAW_SUMS}
    FROM (SELECT DISTINCT * FROM d276_imports) AS r LEFT JOIN import_classes AS c ON c.ccc = r.ccc GROUP BY ALL""",
)
def agg_d276_hh(t):
    """The sum of the raw rows, before multipliers and flags."""
    rows = d276.parse(t.raw_d276).where(d276.is_import() & F.col("settlement_run").isin(IMPORT_RUNS))
    return d276.class_totals(rows, d276.IMPORT_KEYS, IMPORT_CLASSES)


@query(
    "agg_d276_exports",
    f"date:d settlement_run gsp_area settlement_period description sector actual_estimate peak ccc {RAW_SPEC}",
    f"""SELECT date, settlement_run, gsp_area, settlement_period, description, sector, actual_estimate,
    {peak_sql('settlement_period')} AS peak, r.ccc, {RAW_SUMS}
    FROM (SELECT DISTINCT * FROM d276_parsed WHERE NOT ({NOT_EXPORT})) AS r
    LEFT JOIN export_classes AS c ON c.ccc = r.ccc GROUP BY ALL""",
)
def agg_d276_exports(t):
    """The sum of the raw rows of every run, before the choice of the last."""
    rows = d276.parse(t.raw_d276).where(d276.is_export())
    return d276.class_totals(rows, d276.EXPORT_KEYS, EXPORT_CLASSES)


@query(
    "agg_d277_hh",
    "date:d file_date:d settlement_run settlement_period peak gsp_area profile_class sector estimate_gwh:f"
    " estimate_loss_gwh:f corrected_estimate_gwh:f corrected_estimate_loss_gwh:f estimate_meters:f advance_gwh:f"
    " advance_loss_gwh:f corrected_advance_gwh:f corrected_advance_loss_gwh:f advance_meters:f",
    """SELECT *, est AS estimate_gwh, est_loss AS estimate_loss_gwh, c_est AS corrected_estimate_gwh,
    c_est_loss AS corrected_estimate_loss_gwh, est_meters AS estimate_meters, act AS advance_gwh,
    act_loss AS advance_loss_gwh, c_act AS corrected_advance_gwh, c_act_loss AS corrected_advance_loss_gwh,
    act_meters AS advance_meters FROM d277_sums""",
)
def agg_d277_hh(t):
    return d277.profile_totals(inputs.d277_half_hours(t))


@query(
    "agg_d277_quality",
    "date:d file_date:d settlement_run settlement_period peak gsp_area sector profile_class data_quality"
    " uncorrected_consumption_gwh:f uncorrected_line_loss_gwh:f corrected_consumption_gwh:f"
    " corrected_line_loss_gwh:f meters_count:f",
    """SELECT *, 'Estimate' AS data_quality, est AS uncorrected_consumption_gwh, est_loss AS uncorrected_line_loss_gwh,
    c_est AS corrected_consumption_gwh, c_est_loss AS corrected_line_loss_gwh, est_meters AS meters_count FROM d277_sums
    UNION ALL SELECT *, 'Actual', act, act_loss, c_act, c_act_loss, act_meters FROM d277_sums""",
)
def agg_d277_quality(t):
    parts = [
        "uncorrected_consumption_gwh", "uncorrected_line_loss_gwh", "corrected_consumption_gwh",
        "corrected_line_loss_gwh", "meters_count",
    ]
    split = d277.split_quality(d277.profile_totals(inputs.d277_half_hours(t)))
    return split.groupBy(*d277.KEYS, "data_quality").agg(*measures.sums(*parts))


@query("agg_daily_276", DAY_SPEC, "SELECT * FROM d276_daily")
def agg_daily_276(t):
    return measures.day_totals(inputs.d276_hh(t))


@query("agg_peak_276", DAY_SPEC, "SELECT * FROM d276_peak")
def agg_peak_276(t):
    return measures.peak_totals(inputs.d276_hh(t))


@query("agg_daily_277", DAY_SPEC, "SELECT * FROM d277_daily")
def agg_daily_277(t):
    return measures.day_totals(inputs.d277_hh(t))


@query("agg_peak_277", DAY_SPEC, "SELECT * FROM d277_peak")
def agg_peak_277(t):
    return measures.peak_totals(inputs.d277_hh(t))


@query("agg_daily_gross", DAY_SPEC, "SELECT * FROM gross_demand_daily")
def agg_daily_gross(t):
    return measures.day_totals(inputs.gross_demand(t), meters=F.sum)


@query(
    "agg_big_demand",
    "settlementdate:d settlementruntype settlementperiod estimateindicator enapp_class volume_gwh:f",
    """SELECT settlementdate, settlementruntype, settlementperiod, estimateindicator, enapp_class,
    sum(metervolume) / 1000 AS volume_gwh FROM big_demand_rows GROUP BY ALL""",
)
def agg_big_demand(t):
    return c042.big_demand_totals(c042.big_demand_rows(t.raw_c042, inputs.unit_dim(t)))


@query("agg_export_total", "settlement_date:d settlement_period p315_volume_gwh:f", "SELECT * FROM export_totals")
def agg_export_total(t):
    return embedded.export_totals(inputs.exports(t))


CLASS_SPEC = "settlement_date:d settlement_period enapp_class all_notify classification volume_gwh:f"


@query("agg_embedded_class", CLASS_SPEC, "SELECT * FROM embedded_classes")
def agg_embedded_class(t):
    return embedded.classified(inputs.s014_last(t))


@query("agg_embedded_total", "settlement_date:d settlement_period known_gwh:f", "SELECT * FROM embedded_known")
def agg_embedded_total(t):
    known = embedded.classified(inputs.s014_last(t))
    return known.groupBy(*embedded.PERIOD).agg(F.sum("volume_gwh").alias("known_gwh"))


@query("agg_capacity_mean", MEANS, "SELECT * FROM unit_means")
def agg_capacity_mean(t):
    return means(t)


@query(
    "agg_bounds", "source min_date:d max_date:d",
    """SELECT 'orders' AS source, min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date FROM orders
    UNION ALL SELECT 'd276', min(date), max(date) FROM d276_parsed""",
)
def agg_bounds(t):
    orders = t.table("orders").select(F.col("o_orderdate").cast("date").alias("date"))
    sides = {"orders": orders, "d276": d276.parse(t.raw_d276)}
    first, second = [
        ranges.bounds(df, "date").withColumn("source", F.lit(name)) for name, df in sides.items()
    ]
    return first.unionByName(second)


@query(
    "distinct_rows",
    "date:d file_date:d settlement_run gsp_area ccc settlement_period a:f h:f m:f c:f meters_count",
    "SELECT DISTINCT * FROM d276_parsed",
)
def distinct_rows(t):
    return d276.parse(t.raw_d276).dropDuplicates()


@query("union_p315", ALL_SPEC, "SELECT * FROM p315_all_runs")
def union_p315(t):
    return gross.p315(inputs.d276_all(t), inputs.d277_all(t))


@query("union_p315_hh", HH_SPEC, "SELECT * FROM p315_hh")
def union_p315_hh(t):
    return inputs.p315_hh(t)


@query("union_p315_daily", DAY_SPEC, "SELECT * FROM p315_daily")
def union_p315_daily(t):
    return gross.p315(measures.day_totals(inputs.d276_hh(t)), measures.day_totals(inputs.d277_hh(t)))


@query("union_p315_peak", DAY_SPEC, "SELECT * FROM p315_peak")
def union_p315_peak(t):
    return gross.p315(measures.peak_totals(inputs.d276_hh(t)), measures.peak_totals(inputs.d277_hh(t)))


@query(
    "union_gross_demand", "date:d gsp_area aggregation_type description n volume:f",
    """SELECT date, gsp_area, aggregation_type, description, count(*) AS n, sum(total_corrected_consumption_gwh) AS volume
    FROM gross_demand_hh GROUP BY ALL""",
)
def union_gross_demand(t):
    keys = ["date", "gsp_area", "aggregation_type", "description"]
    return inputs.gross_demand(t).groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("total_corrected_consumption_gwh").alias("volume")
    )


SCHEME_SPEC = (
    "date:d settlement_run gsp_area settlement_period aggregation_type description sector actual_estimate peak"
    " uncorrected_consumption_gwh:f uncorrected_line_loss_gwh:f total_uncorrected_consumption_gwh:f"
)


@query("union_positional", SCHEME_SPEC, "SELECT * FROM scheme_later")
def union_positional(t):
    _, profiled, demand = inputs.scheme_inputs(t)
    return levies.later_rows(profiled, demand)


@query("union_ro_fit", f"{SCHEME_SPEC} last_run_ro last_run_fit", "SELECT * FROM ro_fit_rows")
def union_ro_fit(t):
    return levies.scheme_union(*levies.scheme_sides(*inputs.scheme_inputs(t)))


@query("union_embedded", CLASS_SPEC, "SELECT * FROM embedded_rows")
def union_embedded(t):
    return embedded.embedded_rows(*inputs.embedded_inputs(t))


@query(
    "union_quality", "date:d gsp_area profile_class data_quality n volume:f",
    """SELECT date, gsp_area, profile_class, 'Estimate' AS data_quality, count(*) AS n, sum(est) AS volume FROM d277_sums GROUP BY ALL
    UNION ALL SELECT date, gsp_area, profile_class, 'Actual', count(*), sum(act) FROM d277_sums GROUP BY ALL""",
)
def union_quality(t):
    split = d277.split_quality(d277.profile_totals(inputs.d277_half_hours(t)))
    return split.groupBy("date", "gsp_area", "profile_class", "data_quality").agg(
        F.count("*").alias("n"), F.sum("uncorrected_consumption_gwh").alias("volume")
    )


@query(
    "union_units", "source type_code units periods",
    """SELECT source, type_code, count(DISTINCT bmu_id) AS units, count(*) AS periods FROM unit_periods GROUP BY ALL""",
)
def union_units(t):
    return parse_unit_xml(t.raw_unit_xml).groupBy("source", "type_code").agg(
        F.countDistinct("bmu_id").alias("units"), F.count("*").alias("periods")
    )


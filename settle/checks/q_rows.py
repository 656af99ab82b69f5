"""Queries over single row operators: projections, filters, flags."""

from pyspark.sql import functions as F

from settle.checks import inputs
from settle.checks.registry import query
from settle.checks.steps import (
    ATTRIBUTES, FIN_YEAR, NOT_EXPORT, NOT_IMPORT, flag, notify, peak,
)
from settle.functions import calendar, flags, text
from settle.operators import factors, measures, ranges
from settle.plans import c042, d276, d277, s014, units
from settle.session import bounded
from settle.sources.codes import IMPORT_RUNS
from settle.sources.xml import parse_unit_xml

D276_ROW = "date:d file_date:d settlement_run gsp_area ccc settlement_period a:f h:f m:f c:f meters_count"

READABLE = {
    "zpd": "Date", "hdr": "Settlement Run", "gsp": "GSP Area", "spx": "Settlement Period",
    "a": "Supplier Consumption [MWh]", "ccc": "Actual/Estimate Class",
}


@query(
    "proj_rename",
    "date settlement_run gsp_area settlement_period supplier_consumption_mwh actual_estimate_class",
    """SELECT zpd AS date, hdr AS settlement_run, gsp AS gsp_area, spx AS settlement_period,
    a AS supplier_consumption_mwh, ccc AS actual_estimate_class FROM raw_d276""",
)
def proj_rename(t):
    return t.raw_d276.withColumnsRenamed({c: text.plain_name(n) for c, n in READABLE.items()})


@query(
    "proj_drop",
    "bmunitid settlementdate:d settlementruntype settlementperiod estimateindicator importexportindicator metervolume",
    "SELECT * EXCLUDE (player) FROM c042_parsed",
)
def proj_drop(t):
    """Parsed report rows: the columns that only the file transfer needs are gone."""
    return c042.parse(t.raw_c042).drop("player")


@query(
    "proj_select",
    "date:d settlement_run settlement_period actual_estimate volume:f",
    """SELECT settlementdate AS date, settlementruntype AS settlement_run, settlementperiod AS settlement_period,
    estimateindicator AS actual_estimate, metervolume AS volume FROM c042_parsed""",
)
def proj_select(t):
    return c042.parse(t.raw_c042).select(
        F.col("settlementdate").alias("date"),
        F.col("settlementruntype").alias("settlement_run"),
        F.col("settlementperiod").alias("settlement_period"),
        F.col("estimateindicator").alias("actual_estimate"),
        F.col("metervolume").alias("volume"),
    )


@query(
    "proj_const",
    "date:d gsp_area sector aggregation_type corrected_line_loss_gwh:f meters_count n",
    """SELECT date, gsp_area, sector, aggregation_type, corrected_line_loss_gwh, meters_count, count(*) AS n
    FROM big_demand GROUP BY ALL""",
)
def proj_const(t):
    keys = ["date", "gsp_area", "sector", "aggregation_type", "corrected_line_loss_gwh", "meters_count"]
    return inputs.big_demand(t).groupBy(*keys).agg(F.count("*").alias("n"))


VOLUME_SPEC = " ".join(f"{c}:f" for c in measures.VOLUMES)


@query(
    "proj_scale",
    f"date:d file_date:d settlement_run gsp_area ccc settlement_period {VOLUME_SPEC}",
    "SELECT * FROM d276_scaled",
)
def proj_scale(t):
    rows = d276.parse(t.raw_d276).where(d276.is_import() & F.col("settlement_run").isin(IMPORT_RUNS))
    side = bounded(factors.loss_multipliers(t.tlm_rows), within=t.tlm_rows)
    return measures.import_volumes(factors.join_factor(rows.dropDuplicates(), side))


@query(
    "proj_replicate",
    "date:d settlement_run settlement_period description actual_estimate uncorrected_consumption_gwh:f"
    " corrected_consumption_gwh:f total_corrected_consumption_gwh:f total_uncorrected_consumption_gwh:f",
    "SELECT * FROM big_demand",
)
def proj_replicate(t):
    return inputs.big_demand(t)


@query(
    "proj_profile_volumes",
    "date:d gsp_area profile_class settlement_period eac_gwh:f eac_loss_gwh:f corrected_eac_gwh:f"
    " corrected_eac_loss_gwh:f advance_gwh:f advance_loss_gwh:f corrected_advance_gwh:f corrected_advance_loss_gwh:f"
    " unmetered_gwh:f unmetered_loss_gwh:f corrected_unmetered_gwh:f corrected_unmetered_loss_gwh:f",
    """SELECT date, gsp_area, profile_class, settlement_period, sum(eac) AS eac_gwh, sum(eac_loss) AS eac_loss_gwh,
    sum(c_eac) AS corrected_eac_gwh, sum(c_eac_loss) AS corrected_eac_loss_gwh, sum(adv) AS advance_gwh,
    sum(adv_loss) AS advance_loss_gwh, sum(c_adv) AS corrected_advance_gwh, sum(c_adv_loss) AS corrected_advance_loss_gwh,
    sum(unm) AS unmetered_gwh, sum(unm_loss) AS unmetered_loss_gwh, sum(c_unm) AS corrected_unmetered_gwh,
    sum(c_unm_loss) AS corrected_unmetered_loss_gwh FROM d277_volumes GROUP BY ALL""",
)
def proj_profile_volumes(t):
    rows = measures.profile_volumes(inputs.d277_half_hours(t), measures.PROFILE_MEASURES)
    made = [c for c in rows.columns if c.endswith("_gwh")]
    keys = ["date", "gsp_area", "profile_class", "settlement_period"]
    return rows.groupBy(*keys).agg(*measures.sums(*made))


@query("proj_cast", D276_ROW, "SELECT * FROM d276_parsed")
def proj_cast(t):
    return d276.parse(t.raw_d276)


@query("filter_ccc_imports", D276_ROW, f"SELECT * FROM d276_parsed WHERE NOT ({NOT_IMPORT})")
def filter_ccc_imports(t):
    return d276.parse(t.raw_d276).where(d276.is_import())


@query("filter_ccc_exports", D276_ROW, f"SELECT * FROM d276_parsed WHERE NOT ({NOT_EXPORT})")
def filter_ccc_exports(t):
    return d276.parse(t.raw_d276).where(d276.is_export())


@query("filter_runs", D276_ROW, "SELECT * FROM d276_parsed WHERE settlement_run IN ('SF', 'RF', 'DF')")
def filter_runs(t):
    return d276.parse(t.raw_d276).where(F.col("settlement_run").isin(IMPORT_RUNS))


@query(
    "filter_floor_date", "o_orderkey date:d",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderdate >= TIMESTAMP '2015-01-01'"
    " UNION ALL SELECT l_orderkey, DATE '2014-12-20' + CAST(l_linenumber * 4 AS INT) FROM lineitem WHERE l_linenumber >= 3",
)
def filter_floor_date(t):
    orders = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    near = F.date_add(F.lit("2014-12-20").cast("date"), F.col("l_linenumber") * 4)
    lines = t.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), near.alias("date"))
    return ranges.from_floor(orders.unionByName(lines), "date")


HH = "date:d settlement_run gsp_area settlement_period description sector actual_estimate total_corrected_consumption_gwh:f"


@query("filter_last_run", HH, "SELECT * FROM d276_hh")
def filter_last_run(t):
    return d276.last_run(inputs.d276_all(t))


@query("filter_peak", HH, "SELECT * FROM d276_hh WHERE peak = 'P'")
def filter_peak(t):
    return inputs.d276_hh(t).where(F.col("peak") == "P")


UNIT_ROW = (
    "bmunitid settlementdate:d settlementruntype settlementperiod estimateindicator"
    " importexportindicator metervolume:f player"
)


@query("filter_big_demand", f"{UNIT_ROW} enapp_class", "SELECT * FROM big_demand_rows")
def filter_big_demand(t):
    return c042.big_demand_rows(t.raw_c042, inputs.unit_dim(t))


@query("filter_embedded_cva", UNIT_ROW, "SELECT * FROM c042_last WHERE player = 'E_'")
def filter_embedded_cva(t):
    return c042.embedded_units(c042.latest_volumes(t.raw_c042, inputs.unit_dim(t)))


@query(
    "filter_prefix", "bmunitid settlementdate:d settlementperiod settlementruntype enapp_class",
    "SELECT bmunitid, settlementdate, settlementperiod, settlementruntype, enapp_class FROM s014_all"
    " WHERE enapp_class LIKE 'SVA%'",
)
def filter_prefix(t):
    rows = s014.volumes_all_runs(t.raw_s014, inputs.unit_dim(t))
    return rows.where(F.startswith("enapp_class", F.lit("SVA")))


@query(
    "filter_dropna_any", "date:d settlement_run gsp_area profile_class loss_class f:f h:f j:f sector",
    """SELECT DISTINCT *, CASE WHEN profile_class IN (1, 2) THEN 'Domestic' ELSE 'Non-domestic' END AS sector
    FROM d277_parsed WHERE f IS NOT NULL AND profile_class <= 8""",
)
def filter_dropna_any(t):
    return d277.complete_rows(d277.add_sector(d277.parse(t.raw_d277)))


@query(
    "filter_nonzero", "date:d settlement_run gsp_area settlement_period actual_estimate description:s"
    " uncorrected_consumption_gwh:f",
    "SELECT * FROM d277_all_runs",
)
def filter_nonzero(t):
    return inputs.d277_all(t)


@query(
    "filter_date_overlap", "o_orderkey date:d",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN (SELECT greatest(min(CAST(l_shipdate AS DATE)), (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)) FROM lineitem)
      AND (SELECT least(max(CAST(l_shipdate AS DATE)), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) FROM lineitem)""",
)
def filter_date_overlap(t):
    orders = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    lines = t.table("lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    shared = ranges.overlap(ranges.bounds(orders, "date"), ranges.bounds(lines, "date"))
    return ranges.clip(orders, "date", shared)


MEANS = "source type_code bmu_id generation_capacity:f demand_capacity:f"


@query("filter_not_na_code", MEANS, "SELECT * FROM unit_known")
def filter_not_na_code(t):
    return units.known_types(unit_means(t))


def unit_means(t):
    return units.capacity_means(parse_unit_xml(t.raw_unit_xml))


@query("filter_current_version", f"bmunitid {ATTRIBUTES.replace(',', '')}", "SELECT * FROM unit_now")
def filter_current_version(t):
    return units.current_units(inputs.unit_dim(t), *units.ATTRIBUTES)


@query(
    "flag_peak", "zpd gsp spx peak",
    f"SELECT zpd, gsp, spx, {peak('spx')} AS peak FROM raw_d276",
)
def flag_peak(t):
    return t.raw_d276.withColumn("peak", flags.peak("spx"))


@query(
    "flag_day_type", "date:d day_type n",
    """SELECT date, CASE WHEN dayofweek(date) BETWEEN 1 AND 5 AND date NOT IN (SELECT holiday_date FROM non_working)
      THEN 'WD' ELSE 'NWD' END AS day_type, count(*) AS n FROM d276_parsed GROUP BY ALL""",
)
def flag_day_type(t):
    rows = d276.parse(t.raw_d276)
    typed = calendar.add_day_type(rows, inputs.holidays(t), "date", "day_type")
    return typed.groupBy("date", "day_type").agg(F.count("*").alias("n"))


@query(
    "flag_import_export", "bmunitid settlementdate:d settlementperiod bmunitmeteredvolume:f direction",
    """SELECT *, CASE WHEN bmunitmeteredvolume >= 0 THEN 'export' ELSE 'import' END AS direction FROM s014_parsed""",
)
def flag_import_export(t):
    return s014.parse(t.raw_s014).withColumn("direction", flags.import_export("bmunitmeteredvolume"))


@query(
    "flag_estimate", "bmunitid settlementdate:d settlementperiod estimated actual_estimate",
    """SELECT *, CASE WHEN estimated = FALSE THEN 'A' ELSE 'E' END AS actual_estimate FROM (
    SELECT *, CASE WHEN metervolume > 1 THEN estimateindicator END AS estimated FROM c042_parsed) AS r""",
)
def flag_estimate(t):
    rows = c042.parse(t.raw_c042)
    unsure = rows.withColumn("estimated", F.when(F.col("metervolume") > 1, F.col("estimateindicator")))
    return unsure.withColumn("actual_estimate", flags.actual_estimate("estimated"))


def order_dates(t):
    return t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))


ORDER_DATES = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders) AS o"


@query("fin_year", "o_orderkey date:d fy", f"SELECT o_orderkey, date, {FIN_YEAR} AS fy FROM {ORDER_DATES}")
def fin_year(t):
    return order_dates(t).withColumn("fy", calendar.fin_year("date"))


@query(
    "flag_cap_mech", "o_orderkey date:d wd flag_cm",
    f"""SELECT *, CASE WHEN wd = 'wd' AND month(date) IN (11, 12, 1, 2) THEN 1 ELSE 0 END AS flag_cm FROM (
    SELECT o_orderkey, date, CASE WHEN dayofweek(date) BETWEEN 1 AND 5
      AND date NOT IN (SELECT holiday_date FROM non_working) THEN 'wd' ELSE 'nwd' END AS wd FROM {ORDER_DATES}) AS d""",
)
def flag_cap_mech(t):
    typed = calendar.add_day_type(order_dates(t), inputs.holidays(t), "date", "wd", "wd", "nwd")
    return typed.withColumn("flag_cm", calendar.cap_mech("date", "wd"))


@query(
    "flag_ytd", "o_orderkey date:d ytd",
    f"""SELECT o_orderkey, date, CASE WHEN dayofyear(date) <= (SELECT dayofyear(max(date)) FROM {ORDER_DATES})
    THEN 1 ELSE 0 END AS ytd FROM {ORDER_DATES}""",
)
def flag_ytd(t):
    return calendar.add_to_date_flags(order_dates(t))


@query(
    "flag_fytd", "o_orderkey date:d fytd",
    f"""SELECT o_orderkey, date, CASE WHEN dayofyear(date - 90) <= (SELECT dayofyear(max(date) - 90) FROM {ORDER_DATES})
    THEN 1 ELSE 0 END AS fytd FROM {ORDER_DATES}""",
)
def flag_fytd(t):
    return calendar.add_to_date_flags(order_dates(t))


@query(
    "flag_scheme_eligible", "l_orderkey l_linenumber date:d settlement_run ro fit",
    """SELECT *, coalesce(v <= CASE WHEN month(date) IN (2, 3) THEN 2 WHEN month(date) IN (1, 11, 12) THEN 3 ELSE 4 END, FALSE) AS ro,
      coalesce(v <= CASE WHEN month(date) = 3 THEN 2 WHEN month(date) IN (1, 2, 12) THEN 3 ELSE 4 END, FALSE) AS fit
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
      ['II', 'SF', 'R1', 'R2', 'R3', 'RF', 'DF'][l_linenumber] AS settlement_run,
      CASE WHEN l_linenumber <= 5 THEN l_linenumber - 1 END AS v FROM lineitem) AS r""",
)
def flag_scheme_eligible(t):
    runs = F.array(*[F.lit(r) for r in ("II", "SF", "R1", "R2", "R3", "RF", "DF")])
    rows = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("date"),
        F.element_at(runs, F.col("l_linenumber")).alias("settlement_run"),
    )
    rank = flags.scheme_rank("settlement_run")
    return rows.withColumns({
        "ro": flags.ro_eligible("date", rank), "fit": flags.fit_eligible("date", rank),
    })


@query(
    "clamp_missing", "l_orderkey l_linenumber missing:f",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity - known >= 0 THEN l_quantity - known ELSE 0 END AS missing
    FROM (SELECT *, CASE WHEN l_tax > 0 THEN 25 END AS known FROM lineitem) AS r""",
)
def clamp_missing(t):
    known = F.when(F.col("l_tax") > 0, 25.0)
    return t.table("lineitem").withColumn("missing", flags.missing_volume(F.col("l_quantity"), known))


UNIT_FLAGS = "bmu_id effective_from_date:d embedded_cva directcon_cva intercons sva_only"


@query(
    "fill_unit_flags", UNIT_FLAGS,
    f"""SELECT bmu_id, effective_from_date, {flag('embedded_cva', "'E_'")}, {flag('directcon_cva', "'T_', 'M_'")},
    {flag('intercons', "'I_'")}, {flag('sva_only', "'2_'")} FROM unit_dim""",
)
def fill_unit_flags(t):
    return units.fill_unit_flags(inputs.unit_dim(t))


@query(
    "derive_notify", "bmu_id effective_from_date:d all_notify notify_not_sva notify_cva notify_sva",
    f"""SELECT bmu_id, effective_from_date,
    CASE WHEN matched AND all_notify IS NULL THEN coalesce(fpn_flag <> 'F', TRUE) ELSE all_notify END AS all_notify,
    {notify('notify_not_sva', "'C_', 'E_', 'I_', 'M_', 'T_', 'V_'")}, {notify('notify_cva', "'T_', 'E_', 'M_'")},
    {notify('notify_sva', "'2_'")}
    FROM (SELECT u.*, r.fpn_flag, r.bm_unit_id IS NOT NULL AS matched FROM unit_dim AS u
      LEFT JOIN raw_bm_units AS r ON r.bm_unit_id = u.bmu_id) AS m""",
)
def derive_notify(t):
    return units.derive_notify(units.join_registered(inputs.unit_dim(t), t.raw_bm_units))


@query(
    "unit_status", "bmu_id effective_from_date:d currently_active ngc_bmu_flag player",
    "SELECT * FROM unit_dim",
)
def unit_status(t):
    return units.unit_status(t.raw_bmu)


@query(
    "month_start", "o_orderkey month_start:t",
    f"SELECT o_orderkey, CAST(date_trunc('month', date) AS TIMESTAMP) AS month_start FROM {ORDER_DATES}",
)
def month_start(t):
    return order_dates(t).withColumn("month_start", calendar.month_start("date").cast("timestamp_ntz"))


@query(
    "period_start", "zpd spx start:t",
    "SELECT zpd, spx, strptime(zpd, '%Y%m%d') + to_minutes(CAST((spx - 1) * 30 AS BIGINT)) AS start FROM raw_d276",
)
def period_start(t):
    rows = t.raw_d276.withColumn("date", text.compact_date("zpd"))
    return rows.withColumn("start", calendar.period_start("date", "spx"))


@query(
    "row_mean", "s_suppkey mean:f",
    """SELECT s_suppkey, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE (a + b) / 2 END AS mean FROM (
    SELECT s_suppkey, CASE WHEN s_nationkey > 5 THEN s_acctbal END AS a,
      CASE WHEN s_nationkey < 12 THEN CAST(s_nationkey AS DOUBLE) END AS b FROM supplier) AS r""",
)
def row_mean(t):
    rows = t.table("supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") > 5, F.col("s_acctbal")).alias("a"),
        F.when(F.col("s_nationkey") < 12, F.col("s_nationkey").cast("double")).alias("b"),
    )
    return rows.withColumn("mean", flags.row_mean("a", "b"))


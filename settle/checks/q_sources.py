"""Queries over sources, sinks and literal dimensions."""

from pyspark.sql import functions as F

from settle.checks import inputs
from settle.checks.registry import query
from settle.checks.steps import run_rank
from settle.functions.flags import run_rank as rank_column
from settle.operators import factors
from settle.plans import d276, d277, units
from settle.schemas import LLF_FILE, PERIOD_COLUMNS
from settle.session import fresh_path
from settle.sources import files, holidays, names, tables, xml
from settle.sources.codes import BM_UNIT_COLUMNS, IMPORT_CLASSES

DAY_FIRST = "dd/MM/yyyy"


@query("scan_table", "zpd hdr gsp ccc spx a", "SELECT zpd, hdr, gsp, ccc, spx, a FROM raw_d276")
def scan_table(t):
    """Half of the rows by path, half by catalog name."""
    path, columns = fresh_path(t.spark, "d276") + "/table", ["zpd", "hdr", "gsp", "ccc", "spx", "a"]
    even = F.col("ccc") % 2 == 0
    tables.sink_table(t.raw_d276.where(even), path)
    tables.sink_table(t.raw_d276.where(~even), name := f"{inputs.fresh_schema(t.spark)}.d276")
    by_name = tables.scan_table(t.spark, name, columns)
    return tables.scan_table(t.spark, path, columns).unionByName(by_name)


def land_llf(t):
    """Two folders of files with day-first dates; the second repeats the first."""
    date = {c: F.date_format(c, DAY_FIRST) for c in ("start_settlement_date", "end_settlement_date")}
    raw = t.raw_llf.withColumns(date).withColumn("distributor_business_id", F.lit("10"))
    columns = ["distributor_business_id", *files.LLF_COLUMNS]
    named = raw.select(*[F.col(c).alias(c.upper()) for c in columns])
    iso = {c.upper(): F.date_format(F.to_date(c.upper(), DAY_FIRST), "yyyy-MM-dd") for c in date}
    path = inputs.land_csv(named, "llf", iso)
    named.write.option("header", True).csv(f"{path}/again/deeper")
    return path


LLF_SPEC = (
    "market_participant_id llf_class_id start_settlement_date:d end_settlement_date:d day_type"
    " value:f start_settlement_period end_settlement_period"
)


@query(
    "scan_csv_many",
    "market_participant_id llf_class_id day_type value:f n",
    "SELECT market_participant_id, llf_class_id, day_type, value, 2 * count(*) AS n FROM raw_llf GROUP BY ALL",
)
def scan_csv_many(t):
    rows = files.scan_csv_many(t.spark, land_llf(t), LLF_FILE)
    keys = ["market_participant_id", "llf_class_id", "day_type", "value"]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


@query("load_llf", LLF_SPEC, "SELECT DISTINCT * FROM raw_llf")
def load_llf(t):
    return files.load_llf(t.spark, land_llf(t))


def land_tlm(t):
    raw = t.raw_tlm.select(
        F.date_format("settlement_date", DAY_FIRST).alias("Settlement Date"),
        F.col("settlement_run_type").alias("Settlement Run Type"),
        F.col("settlement_period").alias("Settlement Period"),
        F.col("zone").alias("Zone"),
        F.col("off_taking").alias("Off Taking"),
        F.col("delivering").alias("Delivering"),
    )
    return inputs.land_csv(raw, "tlm", {"Settlement Date": F.date_format(F.to_date("Settlement Date", DAY_FIRST), "yyyy-MM-dd")})


@query(
    "load_tlm",
    "settlement_date:d settlement_run_type settlement_period off_taking:f delivering:f gsp_area",
    "SELECT * FROM tlm_rows",
)
def load_tlm(t):
    return files.load_tlm(t.spark, land_tlm(t))


def land_gcf(t):
    raw = t.raw_gcf.select(
        F.col("gsp_area").alias("GSP_GROUP_ID"),
        F.col("settlement_date").alias("SETTLEMENT_DATE"),
        F.col("run_type").alias("SSR_RUN_TYPE"),
        F.col("settlement_period").alias("SETTLEMENT_PERIOD"),
        F.col("gcf").alias("GSP_GROUP_CORRECTION_FACTOR"),
    )
    return inputs.land_csv(raw, "gcf", {"SETTLEMENT_DATE": F.date_format("SETTLEMENT_DATE", DAY_FIRST)})


@query(
    "load_gcf",
    "gsp_area settlement_date:d run_type settlement_period gcf:f",
    "SELECT * FROM raw_gcf",
)
def load_gcf(t):
    return files.load_gcf(t.spark, land_gcf(t))


PC_SPEC = (
    "profile_class_id gsp_group_id std_settlement_config_id time_pattern_regime_id settlement_date:d "
    + " ".join(f"{c}:f" for c in PERIOD_COLUMNS)
)


@query("load_pc", PC_SPEC, "SELECT * FROM raw_pc")
def load_pc(t):
    raw = t.raw_pc
    return files.load_pc(t.spark, inputs.land_csv(raw.toDF(*[c.upper() for c in raw.columns]), "pc"))


def land_units(t):
    """Two lists as published: preamble with commas, header, units; some units have an id only."""
    spelled = {c: c.replace("_", " ").title() for c in BM_UNIT_COLUMNS}
    path = fresh_path(t.spark, "bmunits")
    for i, order in enumerate((BM_UNIT_COLUMNS, BM_UNIT_COLUMNS[::-1])):
        part = t.listed_units.where(F.pmod(F.xxhash64("bm_unit_id"), F.lit(2)) == i)
        columns = [F.col(c) if c in part.columns else F.lit(None).cast("string").alias(c) for c in order]
        header = ",".join(spelled[c] for c in order)
        top = ["Registered units,2020-04-01", "Created for settlement, all regions", header]
        inputs.land_lines(part.select(*columns), top, f"{path}/{i}")
    return path


@query(
    "load_bm_units",
    "bm_unit_id bmu_name party_id fpn_flag n_columns",
    "SELECT *, 28 AS n_columns FROM listed_units",
)
def load_bm_units(t):
    loaded = files.load_bm_units(t.spark, land_units(t))
    return loaded.select("bm_unit_id", "bmu_name", "party_id", "fpn_flag", F.lit(len(loaded.columns)).alias("n_columns"))


@query(
    "parse_unit_xml",
    "source type_code bmu_id settlement_date:d settlement_period gc:f dc:f",
    "SELECT * FROM unit_periods",
)
def parse_unit_xml(t):
    return xml.parse_unit_xml(t.raw_unit_xml)


@query(
    "lit_dim",
    "hdr run_rank ccc description sector actual_estimate n",
    f"""SELECT hdr, {run_rank('hdr')} AS run_rank, r.ccc, description, sector, actual_estimate, count(*) AS n
    FROM raw_d276 AS r LEFT JOIN import_classes AS c ON c.ccc = r.ccc GROUP BY ALL""",
)
def lit_dim(t):
    rows = d276.add_class(t.raw_d276.select("hdr", "ccc"), IMPORT_CLASSES)
    ranked = rows.withColumn("run_rank", rank_column("hdr"))
    keys = ["hdr", "run_rank", "ccc", "description", "sector", "actual_estimate"]
    return ranked.groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "lit_lookup",
    "bmu_id neta_type neta_name ngc_type ngc_name power_station_id power_station_name",
    """SELECT f.bmu_id, f.type_code AS neta_type, fuel_name AS neta_name, g.type_code AS ngc_type,
      CASE WHEN g.type_code = 'NA' THEN 'Not Applicable' ELSE grid_name END AS ngc_name,
      s.type_code AS power_station_id, power_station_name
    FROM unit_types AS f JOIN unit_types AS g ON g.bmu_id = f.bmu_id AND g.source = 'grid'
    JOIN unit_types AS s ON s.bmu_id = f.bmu_id AND s.source = 'station'
    LEFT JOIN fuel_names AS fn ON fn.code = f.type_code LEFT JOIN grid_names AS gn ON gn.code = g.type_code
    LEFT JOIN raw_station AS st ON st.power_station_id = s.type_code WHERE f.source = 'fuel'""",
)
def lit_lookup(t):
    columns = {"fuel": "neta_type", "grid": "ngc_type", "station": "power_station_id"}
    types = t.unit_types.where(F.col("source").isin(*columns)).groupBy("bmu_id").agg(*[
        F.max(F.when(F.col("source") == s, F.col("type_code"))).alias(c) for s, c in columns.items()
    ])
    return names.with_station_names(names.with_type_names(types), t.raw_station)


@query("dim_holiday", "holiday_date:d wd", "SELECT holiday_date, 'NWD' AS wd FROM non_working")
def dim_holiday(t):
    return holidays.working_calendar(t.raw_holiday)


@query(
    "period_grid",
    "date:d settlement_period readings",
    """SELECT d.date, p.sp AS settlement_period, count(r.ccc) AS readings
    FROM (SELECT DISTINCT date FROM d276_parsed) AS d CROSS JOIN range(1, 51) AS p(sp)
    LEFT JOIN d276_parsed AS r ON r.date = d.date AND r.settlement_period = p.sp GROUP BY ALL""",
)
def period_grid(t):
    rows = d276.parse(t.raw_d276)
    counts = rows.groupBy("date", "settlement_period").agg(F.count("*").alias("readings"))
    grid = factors.cross_periods(rows.select("date").distinct())
    joined = grid.join(counts, ["date", "settlement_period"], "left")
    return joined.withColumn("readings", F.coalesce("readings", F.lit(0)))


@query(
    "sink_table",
    "date:d gsp_area settlement_period description total_corrected_consumption_gwh:f",
    "SELECT date, gsp_area, settlement_period, description, total_corrected_consumption_gwh FROM d276_all_runs",
)
def sink_table(t):
    columns = ["date", "gsp_area", "settlement_period", "description"]
    demand = inputs.d276_all(t).select(*columns, "total_corrected_consumption_gwh")
    path = fresh_path(t.spark, "demand") + "/table"
    tables.sink_table(demand.select("date", "gsp_area").limit(0), path)
    tables.sink_table(demand, path, mode="overwrite", by=["date"])
    return tables.scan_table(t.spark, path)


@query(
    "join_sector",
    "profile_class sector n",
    """SELECT profile_class, CASE WHEN profile_class IN (1, 2) THEN 'Domestic'
      WHEN profile_class BETWEEN 3 AND 8 THEN 'Non-domestic' END AS sector, count(*) AS n
    FROM d277_parsed GROUP BY ALL""",
)
def join_sector(t):
    rows = d277.add_sector(d277.parse(t.raw_d277))
    return rows.groupBy("profile_class", "sector").agg(F.count("*").alias("n"))


@query(
    "join_unit_category",
    "enapp_class enapp_category n",
    "SELECT enapp_class, enapp_category, count(*) AS n FROM s014_all GROUP BY ALL",
)
def join_unit_category(t):
    current = units.current_units(inputs.unit_dim(t), "enapp_class")
    rows = units.join_categories(
        t.raw_s014.select("bmunitid"), units.unit_categories(current)
    )
    return rows.groupBy("enapp_class", "enapp_category").agg(F.count("*").alias("n"))


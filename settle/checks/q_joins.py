"""Queries over joins, reshapes and the choice of the latest run."""

from pyspark.sql import functions as F

from settle.checks import inputs
from settle.checks.registry import query
from settle.checks.steps import last_run, run_rank
from settle.functions import calendar, flags
from settle.operators import factors, ranges, runs
from settle.plans import c042, d276, d277, embedded, levies, s014, units
from settle.session import bounded
from settle.sources.codes import IMPORT_CLASSES, IMPORT_RUNS
from settle.sources.xml import parse_unit_xml

D276_KEYS = "date:d file_date:d settlement_run gsp_area ccc settlement_period"


@query(
    "join_run_rank", "settlement_run rank_value n",
    f"SELECT settlement_run, {run_rank('settlement_run')} AS rank_value, count(*) AS n FROM d276_parsed GROUP BY ALL",
)
def join_run_rank(t):
    ranked = d276.parse(t.raw_d276).withColumn("rank_value", flags.run_rank("settlement_run"))
    return ranked.groupBy("settlement_run", "rank_value").agg(F.count("*").alias("n"))


@query(
    "join_tlm", f"{D276_KEYS} off_taking:f",
    """SELECT r.*, off_taking FROM d276_parsed AS r LEFT JOIN tlm_one AS x ON x.settlement_date = r.date
    AND x.gsp_area = r.gsp_area AND x.settlement_period = r.settlement_period""",
)
def join_tlm(t):
    side = bounded(factors.loss_multipliers(t.tlm_rows), within=t.tlm_rows)
    return factors.join_factor(d276.parse(t.raw_d276), side)


@query(
    "join_gcf", f"{D276_KEYS} gcf:f",
    """SELECT r.*, gcf FROM d276_parsed AS r LEFT JOIN raw_gcf AS x ON x.settlement_date = r.date
    AND x.gsp_area = r.gsp_area AND x.settlement_period = r.settlement_period""",
)
def join_gcf(t):
    side = bounded(factors.grid_factors(t.raw_gcf), within=t.raw_gcf)
    return factors.join_factor(d276.parse(t.raw_d276), side)


PROFILE_KEYS = ["profile_class", "gsp_area", "configuration", "regime", "date"]


@query(
    "join_profile_coef",
    "date:d gsp_area profile_class configuration regime settlement_period n share:f",
    """SELECT r.date, r.gsp_area, r.profile_class, r.configuration, r.regime, p.settlement_period,
      count(*) AS n, sum(pc) AS share
    FROM d277_parsed AS r JOIN pc_long AS p ON p.profile_class = r.profile_class AND p.gsp_area = r.gsp_area
    AND p.configuration = r.configuration AND p.regime = r.regime AND p.date = r.date GROUP BY ALL""",
)
def join_profile_coef(t):
    """Rows of the same profile and day are counted before they grow into periods."""
    counted = d277.parse(t.raw_d277).groupBy(*PROFILE_KEYS).agg(F.count("*").alias("rows"))
    joined = counted.join(factors.day_profiles(t.raw_pc), PROFILE_KEYS)
    spread = joined.select(*PROFILE_KEYS, "rows", F.posexplode("shares").alias("place", "pc"))
    shown = spread.where(F.col("pc").isNotNull()).withColumn("settlement_period", F.col("place") + 1)
    return shown.groupBy(*PROFILE_KEYS, "settlement_period").agg(
        F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("pc")).alias("share")
    )


@query(
    "join_llf_range",
    "date:d distributor loss_class day_type first_period last_period llf:f n",
    """SELECT date, distributor, loss_class, r.day_type, start_settlement_period AS first_period,
      end_settlement_period AS last_period, value AS llf, count(*) AS n
    FROM (SELECT *, CASE WHEN dayofweek(date) BETWEEN 1 AND 5
      AND date NOT IN (SELECT holiday_date FROM non_working) THEN 'WD' ELSE 'NWD' END AS day_type FROM d277_parsed) AS r
    JOIN raw_llf AS l ON l.llf_class_id = r.loss_class AND l.market_participant_id = r.distributor
      AND l.day_type = r.day_type AND r.date BETWEEN l.start_settlement_date AND l.end_settlement_date
    GROUP BY ALL""",
)
def join_llf_range(t):
    rows = d277.parse(t.raw_d277)
    typed = calendar.add_day_type(rows, inputs.holidays(t), "date", "day_type")
    bands = factors.loss_bands(t.raw_llf, ranges.bounds(rows, "date"))
    bands = bounded(factors.bands_in_use(bands, d277.classes_in_use(rows)))
    keys = ["date", "distributor", "loss_class", "day_type", "first_period", "last_period", "llf"]
    return factors.join_loss_bands(typed, bands).groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "cross_periods", "settlement_run settlement_period n total:f",
    """SELECT hdr AS settlement_run, sp AS settlement_period, count(*) AS n, sum(TRY_CAST(g AS DOUBLE) * sp) AS total
    FROM raw_d277 CROSS JOIN range(1, 51) AS p(sp) GROUP BY ALL""",
)
def cross_periods(t):
    rows = factors.cross_periods(d277.parse(t.raw_d277))
    return rows.groupBy("settlement_run", "settlement_period").agg(
        F.count("*").alias("n"), F.sum(F.col("g") * F.col("settlement_period")).alias("total")
    )


@query(
    "join_ccc_class", f"{D276_KEYS} description sector actual_estimate",
    "SELECT * FROM d276_parsed LEFT JOIN import_classes USING (ccc)",
)
def join_ccc_class(t):
    return d276.add_class(d276.parse(t.raw_d276), IMPORT_CLASSES)


@query(
    "join_calendar", "o_orderkey date:d wd",
    """SELECT o_orderkey, date, coalesce(wd, 'W') AS wd FROM (
      SELECT o_orderkey, (DATE '2020-03-25' + CAST(o_orderkey % 21 AS INT)) AS date FROM orders) AS o
    LEFT JOIN (SELECT holiday_date AS date, 'NWD' AS wd FROM non_working) AS h USING (date)""",
)
def join_calendar(t):
    start = F.lit("2020-03-25").cast("date")
    orders = t.table("orders").select(
        "o_orderkey", F.date_add(start, (F.col("o_orderkey") % 21).cast("int")).alias("date")
    )
    days = inputs.holidays(t).withColumnRenamed("holiday_date", "date")
    return orders.join(days, "date", "left").withColumn("wd", F.coalesce("wd", F.lit("W")))


ATTRIBUTE_SPEC = " ".join(units.ATTRIBUTES)
C042_SPEC = (
    "bmunitid settlementdate:d settlementruntype settlementperiod estimateindicator"
    f" importexportindicator metervolume:f player {ATTRIBUTE_SPEC}"
)


@query("join_unit_attrs", C042_SPEC, "SELECT * FROM c042_parsed LEFT JOIN unit_now USING (bmunitid)")
def join_unit_attrs(t):
    current = bounded(units.current_units(inputs.unit_dim(t), *units.ATTRIBUTES))
    return c042.parse(t.raw_c042).join(current, "bmunitid", "left")


SOURCE_SPEC = (
    "bmu_id neta_type ngc_type power_station_id all_notify notify_not_sva notify_cva notify_sva"
    " embedded_cva directcon_cva intercons sva_only generation_capacity:f demand_capacity:f"
)


@query("join_unit_sources", SOURCE_SPEC, "SELECT * FROM unit_source_rows")
def join_unit_sources(t):
    return units.unit_sources(units.known_types(means(t)))


def means(t):
    return units.capacity_means(parse_unit_xml(t.raw_unit_xml))


@query(
    "join_units_merge", "bmu_id effective_from_date:d fpn_flag matched",
    """SELECT u.*, r.fpn_flag, r.bm_unit_id IS NOT NULL AS matched FROM unit_dim AS u
    LEFT JOIN raw_bm_units AS r ON r.bm_unit_id = u.bmu_id""",
)
def join_units_merge(t):
    return units.join_registered(inputs.unit_dim(t), t.raw_bm_units)


@query(
    "join_complement",
    "settlement_date:d settlement_period enapp_class all_notify classification volume_gwh:f",
    "SELECT * FROM embedded_missing",
)
def join_complement(t):
    exports, volumes = inputs.embedded_inputs(t)
    return embedded.complement(embedded.export_totals(exports), embedded.classified(volumes))


CHOSEN = (
    "date:d settlement_run gsp_area settlement_period aggregation_type description sector actual_estimate"
    " uncorrected_consumption_gwh:f last_run_ro last_run_fit"
)


def chosen(t):
    _, profiled, demand = inputs.scheme_inputs(t)
    return levies.chosen_runs(levies.eligible_runs(levies.later_rows(profiled, demand)))


@query("join_flag_back", CHOSEN, "SELECT * FROM scheme_chosen")
def join_flag_back(t):
    return chosen(t)


@query(
    "last_run_scheme",
    "date:d gsp_area settlement_run last_run_ro last_run_fit n volume:f",
    """SELECT date, gsp_area, settlement_run, last_run_ro, last_run_fit, count(*) AS n,
      sum(uncorrected_consumption_gwh) AS volume FROM scheme_chosen GROUP BY ALL""",
)
def last_run_scheme(t):
    keys = ["date", "gsp_area", "settlement_run", "last_run_ro", "last_run_fit"]
    return chosen(t).groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("uncorrected_consumption_gwh").alias("volume")
    )


@query("last_run_276", f"{D276_KEYS} last_run_flag", "SELECT * FROM d276_imports")
def last_run_276(t):
    rows = d276.parse(t.raw_d276).where(d276.is_import() & F.col("settlement_run").isin(IMPORT_RUNS))
    rank = flags.run_rank("settlement_run")
    best = bounded(runs.latest_rank(rows, runs.HALF_HOUR, rank))
    return runs.flag_last_run(rows, best, runs.HALF_HOUR, rank)


@query("last_run_exports", D276_KEYS, "SELECT * FROM d276_export_last")
def last_run_exports(t):
    rows = d276.parse(t.raw_d276).where(d276.is_export())
    rank = flags.run_rank("settlement_run")
    best = bounded(runs.latest_rank(rows, runs.HALF_HOUR, rank))
    return runs.keep_last_run(rows, best, runs.HALF_HOUR, rank)


@query(
    "last_run_277", "date:d file_date:d settlement_run gsp_area profile_class last_run_flag",
    "SELECT * FROM d277_flagged",
)
def last_run_277(t):
    rows = d277.parse(t.raw_d277)
    rank = flags.run_rank("settlement_run")
    best = bounded(runs.latest_rank(rows, runs.DAY, rank))
    return runs.flag_last_run(rows, best, runs.DAY, rank)


@query(
    "last_run_s014", "bmunitid settlementdate:d settlementperiod settlementruntype last_run_flag",
    f"SELECT *, {last_run('settlementruntype', 'settlementdate, settlementperiod, bmunitid')} AS last_run_flag FROM s014_parsed",
)
def last_run_s014(t):
    rows = s014.parse(t.raw_s014)
    rank = flags.run_rank("settlementruntype")
    return runs.flag_last_run(rows, runs.latest_rank(rows, runs.UNIT_PERIOD, rank), runs.UNIT_PERIOD, rank)


@query(
    "last_run_c042",
    "bmunitid settlementdate:d settlementperiod importexportindicator settlementruntype last_run_flag",
    "SELECT *, "
    + last_run("settlementruntype", "settlementdate, settlementperiod, bmunitid, importexportindicator")
    + " AS last_run_flag FROM c042_parsed",
)
def last_run_c042(t):
    rows = c042.parse(t.raw_c042)
    rank = flags.run_rank("settlementruntype")
    best = runs.latest_rank(rows, runs.UNIT_DIRECTION, rank)
    return runs.flag_last_run(rows, best, runs.UNIT_DIRECTION, rank)


@query(
    "last_run_big_demand", "date:d settlement_run settlement_period description last_run_flag",
    f"SELECT *, {last_run('settlement_run', 'date, settlement_period, description')} AS last_run_flag FROM big_demand",
)
def last_run_big_demand(t):
    ranks = {"last_run_flag": flags.run_rank("settlement_run")}
    return runs.flag_last_run_of_totals(inputs.big_demand(t), runs.CLASS_PERIOD, ranks)


@query("last_version_unit", "bmu_id effective_from_date:d last_flag", "SELECT * FROM unit_dim")
def last_version_unit(t):
    return runs.last_version(t.raw_bmu)


@query(
    "top1_date", "settlement_run first_date:d last_date:d",
    "SELECT settlement_run, min(date) AS first_date, max(date) AS last_date FROM d276_parsed GROUP BY ALL",
)
def top1_date(t):
    return d276.parse(t.raw_d276).groupBy("settlement_run").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query(
    "unpivot_pc",
    "profile_class_id gsp_group_id std_settlement_config_id time_pattern_regime_id settlement_date:d settlement_period pc:f",
    """SELECT * EXCLUDE (ppc), CAST(substr(ppc, 5) AS INT) AS settlement_period
    FROM (SELECT * FROM raw_pc UNPIVOT INCLUDE NULLS (pc FOR ppc IN (COLUMNS('ppc_[0-9]+')))) AS u""",
)
def unpivot_pc(t):
    return factors.unpivot_profiles(t.raw_pc)


@query(
    "classify_embedded",
    "settlement_date:d settlement_period enapp_class all_notify player classification mwh:f",
    """SELECT settlement_date, settlement_period, enapp_class, all_notify, player, classification, sum(mwh) AS mwh
    FROM s014_classified GROUP BY ALL""",
)
def classify_embedded(t):
    return embedded.add_classifications(embedded.unit_exports(inputs.s014_last(t)))


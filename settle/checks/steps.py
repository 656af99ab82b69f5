"""Expected results as SQL steps, written from the settlement rules.

The order of work here is the plain one (expand, join, then sum), not that of
the Spark plans, so that the two check each other.
"""

from settle.checks.registry import STEPS
from settle.sources.codes import EXPORT_CLASSES, IMPORT_CLASSES, UNIT_CATEGORY

VOLUMES = [
    "uncorrected_consumption_gwh", "uncorrected_line_loss_gwh",
    "corrected_consumption_gwh", "corrected_line_loss_gwh",
    "total_corrected_consumption_gwh", "total_uncorrected_consumption_gwh",
]


def run_rank(col: str) -> str:
    return (
        f"CASE {col} WHEN 'II' THEN 1 WHEN 'SF' THEN 2 WHEN 'R1' THEN 3 WHEN 'R2' THEN 4"
        " WHEN 'R3' THEN 5 WHEN 'RF' THEN 6 WHEN 'DF' THEN 7 END"
    )


def last_run(col: str, keys: str) -> str:
    rank = run_rank(col)
    return f"coalesce({rank} = max({rank}) OVER (PARTITION BY {keys}), FALSE)"


def scheme_rank(col: str) -> str:
    return (
        f"CASE {col} WHEN 'II' THEN 0 WHEN 'SF' THEN 1 WHEN 'R1' THEN 2 WHEN 'R2' THEN 3"
        " WHEN 'R3' THEN 4 END"
    )


def day(col: str) -> str:
    return f"CAST(strptime(substr({col}, 1, 8), '%Y%m%d') AS DATE)"


def peak(col: str) -> str:
    return f"CASE WHEN {col} BETWEEN 33 AND 38 THEN 'P' ELSE 'N' END"


def class_rows(classes: dict) -> str:
    rows = ", ".join(f"({k}, '{d}', '{s}', '{a}')" for k, (d, s, a) in classes.items())
    return f"SELECT * FROM (VALUES {rows}) AS v(ccc, description, sector, actual_estimate)"


def number(col: str) -> str:
    return f"TRY_CAST({col} AS DOUBLE) AS {col}"


NOT_IMPORT = (
    "ccc BETWEEN 6 AND 8 OR ccc BETWEEN 14 AND 22 OR ccc BETWEEN 32 AND 41"
    " OR ccc BETWEEN 48 AND 53 OR ccc BETWEEN 60 AND 65"
)
NOT_EXPORT = (
    "ccc BETWEEN 1 AND 5 OR ccc BETWEEN 9 AND 13 OR ccc BETWEEN 17 AND 31"
    " OR ccc BETWEEN 42 AND 47 OR ccc BETWEEN 54 AND 59"
)

FIN_YEAR = (
    "CASE WHEN month(date) >= 4 THEN year(date) || '-' || ((year(date) + 1) % 100)"
    " ELSE (year(date) - 1) || '-' || (year(date) % 100) END"
)


def calendar(source: str) -> str:
    return f"""
SELECT * REPLACE (CAST(date AS TIMESTAMP) AS date), {FIN_YEAR} AS fy,
  CAST(date_trunc('month', date) AS TIMESTAMP) AS "month-year", month(date) AS month, year(date) AS year,
  CASE WHEN dayofyear(date) <= (SELECT dayofyear(max(date)) FROM {source}) THEN 1 ELSE 0 END AS ytd,
  CASE WHEN dayofyear(date - 90) <= (SELECT dayofyear(max(date) - 90) FROM {source}) THEN 1 ELSE 0 END AS fytd
FROM {source}"""


def day_totals(source: str, meters: str = "avg", where: str = "TRUE") -> str:
    sums = ", ".join(f"sum({c}) AS {c}" for c in VOLUMES)
    return f"""
SELECT date, settlement_run, gsp_area, aggregation_type, description, sector, actual_estimate,
  {sums}, {meters}(meters_count) AS meters_count
FROM {source} WHERE {where} GROUP BY ALL"""


def flag(name: str, players: str) -> str:
    return f"coalesce({name}, player IN ({players})) AS {name}"


def notify(name: str, players: str) -> str:
    return (
        f"CASE WHEN matched AND all_notify IS NULL THEN coalesce(fpn_flag <> 'F', TRUE) AND player IN ({players})"
        f" ELSE {name} END AS {name}"
    )


ATTRIBUTES = "bsc_party, enapp_name, ngc_name, ngc_bmu_id, ngc_bmu_flag, enapp_class, all_notify"

STEPS.update({
    "non_working": """
SELECT DISTINCT holiday_date FROM raw_holiday
WHERE (label NOT LIKE '%Scotland%' AND label NOT LIKE '%Northern Ireland%')
  OR label LIKE '%England%' OR label LIKE '%New Year''s Day %'""",
    "import_classes": class_rows(IMPORT_CLASSES),
    "export_classes": class_rows(EXPORT_CLASSES),
    "tlm_one": f"""
SELECT settlement_date, settlement_period, gsp_area, off_taking FROM tlm_rows
QUALIFY row_number() OVER (PARTITION BY settlement_date, settlement_period, gsp_area
  ORDER BY {run_rank('settlement_run_type')} DESC, off_taking DESC) = 1""",
    "d276_parsed": f"""
SELECT {day('zpd')} AS date, {day('pool')} AS file_date, hdr AS settlement_run, gsp AS gsp_area, ccc,
  spx AS settlement_period, {number('a')}, {number('h')}, {number('m')}, {number('c')}, ai AS meters_count
FROM raw_d276""",
    "d276_imports": f"""
SELECT *, {last_run('settlement_run', 'date, settlement_period')} AS last_run_flag FROM d276_parsed
WHERE NOT ({NOT_IMPORT}) AND settlement_run IN ('SF', 'RF', 'DF')""",
    "d276_scaled": """
SELECT r.*, 'H' AS aggregation_type, t.off_taking, r.a / 1000 AS uncorrected_consumption_gwh,
  r.h / 1000 AS uncorrected_line_loss_gwh, r.m * t.off_taking / 1000 AS corrected_consumption_gwh,
  r.c * t.off_taking / 1000 AS corrected_line_loss_gwh,
  coalesce(r.m * t.off_taking / 1000, 0) + coalesce(r.c * t.off_taking / 1000, 0) AS total_corrected_consumption_gwh,
  coalesce(r.a / 1000, 0) + coalesce(r.h / 1000, 0) AS total_uncorrected_consumption_gwh
FROM (SELECT DISTINCT * FROM d276_imports) AS r
LEFT JOIN tlm_one AS t ON t.settlement_date = r.date AND t.gsp_area = r.gsp_area
  AND t.settlement_period = r.settlement_period""",
    "d276_all_runs": f"""
SELECT date, file_date, last_run_flag, settlement_run, gsp_area, settlement_period, aggregation_type, description,
  sector, actual_estimate, {peak('settlement_period')} AS peak,
  {", ".join(f"sum({c}) AS {c}" for c in VOLUMES)}, CAST(sum(meters_count) AS BIGINT) AS meters_count
FROM d276_scaled JOIN import_classes USING (ccc) GROUP BY ALL""",
    "d276_hh": "SELECT * EXCLUDE (last_run_flag, file_date) FROM d276_all_runs WHERE last_run_flag",
    "d276_daily": day_totals("d276_hh"),
    "d276_peak": day_totals("d276_hh", where="peak = 'P'"),
    "d276_export_last": f"""
SELECT * FROM d276_parsed WHERE NOT ({NOT_EXPORT})
QUALIFY {last_run('settlement_run', 'date, settlement_period')}""",
    "d276_exports": f"""
SELECT date, settlement_run, gsp_area, settlement_period, description, sector, actual_estimate,
  {peak('settlement_period')} AS peak, ccc, sum(a / 1000) AS uncorrected_consumption_gwh,
  sum(h / 1000) AS uncorrected_line_loss_gwh, sum(m / 1000) AS corrected_consumption_gwh,
  sum(c / 1000) AS corrected_line_loss_gwh,
  sum(coalesce(m / 1000, 0) + coalesce(c / 1000, 0)) AS total_corrected_consumption_gwh,
  sum(coalesce(a / 1000, 0) + coalesce(h / 1000, 0)) AS total_uncorrected_consumption_gwh,
  sum((coalesce(m / 1000, 0) + coalesce(c / 1000, 0)) * off_taking) AS total_tlm_corrected_consumption_gwh,
  CAST(sum(meters_count) AS BIGINT) AS meters_count
FROM (SELECT DISTINCT * FROM d276_export_last) AS r JOIN export_classes USING (ccc)
LEFT JOIN (SELECT settlement_date AS date, settlement_period, gsp_area, off_taking FROM tlm_one) AS t
  USING (date, settlement_period, gsp_area)
GROUP BY ALL""",
    "d277_parsed": f"""
SELECT {day('zpd')} AS date, {day('pool')} AS file_date, hdr AS settlement_run, gsp AS gsp_area,
  TRY_CAST(a AS INT) AS profile_class, b AS configuration, c AS loss_class, d AS distributor,
  TRY_CAST(e AS INT) AS regime, {", ".join(number(x) for x in "fghijklm")}
FROM raw_d277""",
    "d277_flagged": f"""
SELECT *, {last_run('settlement_run', 'date')} AS last_run_flag FROM d277_parsed""",
    "pc_long": """
SELECT TRY_CAST(profile_class_id AS INT) AS profile_class, gsp_group_id AS gsp_area,
  std_settlement_config_id AS configuration, TRY_CAST(time_pattern_regime_id AS INT) AS regime,
  settlement_date AS date, CAST(substr(ppc, 5) AS INT) AS settlement_period, pc
FROM (UNPIVOT raw_pc ON COLUMNS('ppc_[0-9]+') INTO NAME ppc VALUE pc) AS u""",
    "d277_half_hours": """
SELECT r.*, p.settlement_period, p.pc, g.gcf, t.off_taking, l.value AS llf,
  CASE WHEN r.profile_class IN (1, 2) THEN 'Domestic' WHEN r.profile_class BETWEEN 3 AND 8 THEN 'Non-domestic' END AS sector
FROM (SELECT DISTINCT * FROM d277_flagged) AS r
JOIN pc_long AS p ON p.profile_class = r.profile_class AND p.gsp_area = r.gsp_area
  AND p.configuration = r.configuration AND p.regime = r.regime AND p.date = r.date
JOIN tlm_one AS t ON t.settlement_date = r.date AND t.gsp_area = r.gsp_area
  AND t.settlement_period = p.settlement_period
JOIN raw_gcf AS g ON g.settlement_date = r.date AND g.gsp_area = r.gsp_area
  AND g.settlement_period = p.settlement_period
JOIN raw_llf AS l ON r.date BETWEEN l.start_settlement_date AND l.end_settlement_date
  AND p.settlement_period BETWEEN l.start_settlement_period AND l.end_settlement_period
  AND l.llf_class_id = r.loss_class AND l.market_participant_id = r.distributor
  AND l.day_type = CASE WHEN dayofweek(r.date) BETWEEN 1 AND 5
    AND r.date NOT IN (SELECT holiday_date FROM non_working) THEN 'WD' ELSE 'NWD' END""",
    "d277_volumes": """
SELECT *, f / 1000 * pc AS eac, f / 1000 * pc * (llf - 1) AS eac_loss,
  f / 1000 * pc * gcf * off_taking AS c_eac, f / 1000 * pc * gcf * off_taking * (llf - 1) AS c_eac_loss,
  h / 1000 * pc AS adv, h / 1000 * pc * (llf - 1) AS adv_loss,
  h / 1000 * pc * gcf * off_taking AS c_adv, h / 1000 * pc * gcf * off_taking * (llf - 1) AS c_adv_loss,
  j / 1000 * pc AS unm, j / 1000 * pc * (llf - 1) AS unm_loss,
  j / 1000 * pc * gcf * off_taking AS c_unm, j / 1000 * pc * gcf * off_taking * (llf - 1) AS c_unm_loss
FROM d277_half_hours
WHERE f IS NOT NULL AND g IS NOT NULL AND h IS NOT NULL AND i IS NOT NULL AND j IS NOT NULL AND k IS NOT NULL
  AND l IS NOT NULL AND m IS NOT NULL AND sector IS NOT NULL""",
    "d277_sums": f"""
SELECT date, file_date, last_run_flag, settlement_run, settlement_period, {peak('settlement_period')} AS peak, gsp_area,
  profile_class, sector, sum(eac) + sum(unm) AS est, sum(eac_loss) + sum(unm_loss) AS est_loss,
  sum(c_eac) + sum(c_unm) AS c_est, sum(c_eac_loss) + sum(c_unm_loss) AS c_est_loss, sum(g) + sum(k) AS est_meters,
  sum(adv) AS act, sum(adv_loss) AS act_loss, sum(c_adv) AS c_act, sum(c_adv_loss) AS c_act_loss, sum(i) AS act_meters
FROM d277_volumes GROUP BY ALL""",
    "d277_all_runs": """
SELECT date, file_date, last_run_flag, settlement_run, gsp_area, settlement_period, 'N' AS aggregation_type,
  CAST(profile_class AS VARCHAR) AS description, sector, quality AS actual_estimate, peak,
  uncorrected_consumption_gwh, uncorrected_line_loss_gwh, corrected_consumption_gwh, corrected_line_loss_gwh,
  corrected_consumption_gwh + corrected_line_loss_gwh AS total_corrected_consumption_gwh,
  uncorrected_consumption_gwh + uncorrected_line_loss_gwh AS total_uncorrected_consumption_gwh, meters_count
FROM (
  SELECT *, 'E' AS quality, est AS uncorrected_consumption_gwh, est_loss AS uncorrected_line_loss_gwh,
    c_est AS corrected_consumption_gwh, c_est_loss AS corrected_line_loss_gwh, est_meters AS meters_count FROM d277_sums
  UNION ALL
  SELECT *, 'A', act, act_loss, c_act, c_act_loss, act_meters FROM d277_sums
) AS q WHERE uncorrected_consumption_gwh <> 0""",
    "d277_hh": "SELECT * EXCLUDE (last_run_flag, file_date) FROM d277_all_runs WHERE last_run_flag",
    "d277_daily": day_totals("d277_hh"),
    "d277_peak": day_totals("d277_hh", where="peak = 'P'"),
    "unit_dim": """
SELECT *, substr(bmu_id, 1, 2) AS player, effective_to_date IS NULL AS currently_active,
  ngc_bmu_id IS NOT NULL AS ngc_bmu_flag,
  effective_from_date = max(effective_from_date) OVER (PARTITION BY bmu_id) AS last_flag
FROM raw_bmu""",
    "unit_now": f"SELECT bmu_id AS bmunitid, {ATTRIBUTES} FROM unit_dim WHERE last_flag",
    "c042_parsed": """
SELECT bmunitid, CAST(settlementdate AS DATE) AS settlementdate, settlementruntype,
  TRY_CAST(settlementperiod AS INT) AS settlementperiod, estimateindicator, importexportindicator,
  TRY_CAST(metervolume AS DOUBLE) AS metervolume, substr(bmunitid, 1, 2) AS player
FROM raw_c042 WHERE settlementdate >= DATE '2015-01-01'""",
    "c042_last": f"""
SELECT DISTINCT * FROM (SELECT * FROM c042_parsed
  QUALIFY {last_run('settlementruntype', 'settlementdate, settlementperiod, bmunitid, importexportindicator')}) AS r
LEFT JOIN unit_now USING (bmunitid)""",
    "big_demand_rows": """
SELECT DISTINCT r.*, u.enapp_class FROM c042_parsed AS r LEFT JOIN unit_now AS u USING (bmunitid)
WHERE u.enapp_class IN ('CHEMICAL', 'DEMAND', 'RAIL', 'STEEL') AND r.importexportindicator = 'I'""",
    "big_demand": f"""
SELECT settlementdate AS date, settlementruntype AS settlement_run, 'T-connected' AS gsp_area,
  settlementperiod AS settlement_period, 'H' AS aggregation_type, enapp_class AS description,
  'Non-domestic' AS sector, CASE WHEN estimateindicator = FALSE THEN 'A' ELSE 'E' END AS actual_estimate,
  {peak('settlementperiod')} AS peak, sum(metervolume) / 1000 AS uncorrected_consumption_gwh,
  0e0 AS uncorrected_line_loss_gwh, sum(metervolume) / 1000 AS corrected_consumption_gwh,
  0e0 AS corrected_line_loss_gwh, sum(metervolume) / 1000 AS total_corrected_consumption_gwh,
  sum(metervolume) / 1000 AS total_uncorrected_consumption_gwh, CAST(0 AS BIGINT) AS meters_count
FROM big_demand_rows GROUP BY settlementdate, settlementruntype, settlementperiod, estimateindicator, enapp_class""",
    "big_demand_last": f"""
SELECT * FROM big_demand QUALIFY {last_run('settlement_run', 'date, settlement_period, description')}""",
    "s014_parsed": """
SELECT bmunitid, CAST(settlementdate AS DATE) AS settlementdate, settlementruntype,
  CAST(settlementperiod AS INT) AS settlementperiod, tradingunitname, TRY_CAST(periodfpn AS DOUBLE) AS periodfpn,
  TRY_CAST(bmunitmeteredvolume AS DOUBLE) AS bmunitmeteredvolume,
  TRY_CAST(transmissionlossmultiplier AS DOUBLE) AS transmissionlossmultiplier,
  TRY_CAST(bmunitapplicablebalancingservicesvolume AS DOUBLE) AS bmunitapplicablebalancingservicesvolume
FROM raw_s014""",
    "unit_category": "SELECT * FROM (VALUES "
    + ", ".join(f"('{k}', '{v}')" for k, v in UNIT_CATEGORY.items())
    + ") AS v(enapp_class, enapp_category)",
    "s014_all": """
SELECT r.*, c.enapp_category FROM (
  SELECT r.*, u.* EXCLUDE (bmunitid, enapp_class), coalesce(u.enapp_class, 'NONE') AS enapp_class,
    CASE WHEN r.bmunitmeteredvolume >= 0 THEN 'export' ELSE 'import' END AS importexportindicator,
    substr(r.bmunitid, 1, 2) AS player
  FROM s014_parsed AS r LEFT JOIN unit_now AS u USING (bmunitid)) AS r
LEFT JOIN unit_category AS c USING (enapp_class)""",
    "s014_last": f"""
SELECT DISTINCT * FROM (SELECT * FROM s014_all
  QUALIFY {last_run('settlementruntype', 'settlementdate, settlementperiod, bmunitid')}) AS r""",
    "p315_all_runs": "SELECT * FROM d276_all_runs UNION ALL BY NAME SELECT * FROM d277_all_runs",
    "p315_hh": "SELECT * FROM d276_hh UNION ALL BY NAME SELECT * FROM d277_hh",
    "p315_daily": "SELECT * FROM d276_daily UNION ALL BY NAME SELECT * FROM d277_daily",
    "p315_peak": "SELECT * FROM d276_peak UNION ALL BY NAME SELECT * FROM d277_peak",
    "gross_demand_hh": """
SELECT * FROM p315_hh UNION ALL BY NAME SELECT * FROM big_demand_last
WHERE date BETWEEN (SELECT min(date) FROM p315_hh) AND (SELECT max(date) FROM p315_hh)""",
    "gross_demand_daily": day_totals("gross_demand_hh", meters="sum"),
    "gross_typed": """
SELECT *, CASE WHEN wd = 'wd' AND month(date) IN (11, 12, 1, 2) THEN 1 ELSE 0 END AS flag_cm FROM (
  SELECT *, CASE WHEN dayofweek(date) BETWEEN 1 AND 5 AND date NOT IN (SELECT holiday_date FROM non_working)
    THEN 'wd' ELSE 'nwd' END AS wd FROM gross_demand_hh) AS g""",
    "cap_mech_rows": calendar("gross_typed"),
    "scheme_sf": """
SELECT date, settlement_run, gsp_area, settlement_period, aggregation_type, description, sector, actual_estimate, peak,
  uncorrected_consumption_gwh, uncorrected_line_loss_gwh, total_uncorrected_consumption_gwh
FROM d276_all_runs WHERE settlement_run = 'SF'""",
    "scheme_277": """
SELECT date, settlement_run, gsp_area, settlement_period, aggregation_type, description, sector, actual_estimate, peak,
  uncorrected_consumption_gwh, uncorrected_line_loss_gwh, total_uncorrected_consumption_gwh
FROM d277_all_runs WHERE settlement_run IN ('II', 'SF', 'R1', 'R2', 'R3')""",
    "scheme_big": """
SELECT date, settlement_run, gsp_area, settlement_period, aggregation_type, description, sector, actual_estimate, peak,
  uncorrected_consumption_gwh, uncorrected_line_loss_gwh, total_uncorrected_consumption_gwh
FROM big_demand WHERE settlement_run IN ('II', 'SF', 'R1', 'R2', 'R3')""",
    "scheme_later": f"""
SELECT *, {scheme_rank('settlement_run')} AS rank_value FROM (
  SELECT * FROM scheme_277 UNION ALL SELECT * FROM scheme_big) AS u
WHERE date >= greatest((SELECT min(date) FROM scheme_277), (SELECT min(date) FROM scheme_big))
  AND date <= least((SELECT max(date) FROM scheme_277), (SELECT max(date) FROM scheme_big))""",
    "scheme_eligible": """
SELECT *, rank_value <= CASE month(date) WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 11 THEN 3 WHEN 12 THEN 3 ELSE 4 END AS ro,
  rank_value <= CASE month(date) WHEN 1 THEN 3 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 12 THEN 3 ELSE 4 END AS fit
FROM scheme_later""",
    "scheme_chosen": """
SELECT * FROM (
  SELECT *, coalesce(ro AND rank_value = max(CASE WHEN ro THEN rank_value END) OVER k, FALSE) AS last_run_ro,
    coalesce(fit AND rank_value = max(CASE WHEN fit THEN rank_value END) OVER k, FALSE) AS last_run_fit
  FROM scheme_eligible WHERE ro OR fit
  WINDOW k AS (PARTITION BY date, gsp_area, settlement_period, aggregation_type, description, actual_estimate)) AS w
WHERE last_run_ro OR last_run_fit""",
    "ro_fit_rows": """
SELECT * FROM (
  SELECT *, TRUE AS last_run_ro, TRUE AS last_run_fit FROM scheme_sf
  UNION ALL BY NAME SELECT * EXCLUDE (rank_value, ro, fit) FROM scheme_chosen) AS u
WHERE date >= greatest((SELECT min(date) FROM scheme_sf), (SELECT min(date) FROM scheme_later))
  AND date <= least((SELECT max(date) FROM scheme_sf), (SELECT max(date) FROM scheme_later))""",
    "ro_fit_calendar": calendar("ro_fit_rows"),
    "export_totals": """
SELECT date AS settlement_date, settlement_period, sum(total_tlm_corrected_consumption_gwh) AS p315_volume_gwh
FROM d276_exports WHERE date >= DATE '2015-01-01' GROUP BY ALL""",
    "s014_exports": """
SELECT settlementdate AS settlement_date, settlementperiod AS settlement_period, enapp_class,
  coalesce(all_notify, FALSE) AS all_notify, player,
  bmunitmeteredvolume * transmissionlossmultiplier AS mwh
FROM s014_last WHERE importexportindicator = 'export' AND settlementdate >= DATE '2015-01-01'""",
    "s014_classified": """
SELECT *, 'sva_bmu' AS classification FROM s014_exports WHERE enapp_class LIKE 'SVA%'
UNION ALL SELECT *, 'embedded_bmu' FROM s014_exports WHERE player = 'E_'
UNION ALL SELECT *, 'supplier_cfd' FROM s014_exports WHERE player = 'C_'
UNION ALL SELECT *, 'supplier_embedded_no_cfd' FROM s014_exports WHERE player = '2_' AND enapp_class NOT LIKE 'SVA%'""",
    "embedded_classes": """
SELECT settlement_date, settlement_period, enapp_class, all_notify, classification, sum(mwh) / 1000 AS volume_gwh
FROM s014_classified GROUP BY ALL""",
    "embedded_known": """
SELECT settlement_date, settlement_period, sum(volume_gwh) AS known_gwh FROM embedded_classes GROUP BY ALL""",
    "embedded_missing": """
SELECT settlement_date, settlement_period, 'p315_complement' AS enapp_class, FALSE AS all_notify,
  'metered_gsp_exports' AS classification,
  CASE WHEN p315_volume_gwh - known_gwh >= 0 THEN p315_volume_gwh - known_gwh ELSE 0 END AS volume_gwh
FROM export_totals LEFT JOIN embedded_known USING (settlement_date, settlement_period)""",
    "embedded_rows": "SELECT * FROM embedded_classes UNION ALL BY NAME SELECT * FROM embedded_missing",
    "embedded_flow": """
SELECT *, CAST(settlement_date AS TIMESTAMP) + to_minutes(CAST((settlement_period - 1) * 30 AS BIGINT)) AS settlement_datetime
FROM embedded_rows
WHERE settlement_date >= greatest((SELECT min(date) FROM d276_exports), (SELECT min(settlementdate) FROM s014_last))
  AND settlement_date <= least((SELECT max(date) FROM d276_exports), (SELECT max(settlementdate) FROM s014_last))""",
    "unit_periods": """
SELECT source, type_code, bmu_id, DATE '2020-04-01' AS settlement_date, n AS settlement_period,
  CAST(base * 10 * n AS DOUBLE) AS gc, CAST(dc_base + (n - 1) * 2 AS DOUBLE) AS dc
FROM unit_types CROSS JOIN (VALUES (1), (2)) AS v(n)""",
    "unit_means": """
SELECT source, type_code, bmu_id, avg(gc) AS generation_capacity, avg(dc) AS demand_capacity
FROM unit_periods GROUP BY ALL""",
    "unit_known": """
SELECT * FROM unit_means WHERE NOT (source = 'grid' AND type_code = 'NA')
  AND NOT (source = 'class' AND (generation_capacity IS NULL OR demand_capacity IS NULL))""",
    "unit_source_rows": """
SELECT b.bmu_id, f.type_code AS neta_type, g.type_code AS ngc_type, p.type_code AS power_station_id,
  c.all_notify, c.notify_not_sva, c.notify_cva, c.notify_sva, c.embedded_cva, c.directcon_cva, c.intercons, c.sva_only,
  m.generation_capacity, m.demand_capacity
FROM (SELECT DISTINCT bmu_id FROM unit_known) AS b
LEFT JOIN (SELECT * FROM unit_known WHERE source = 'fuel') AS f USING (bmu_id)
LEFT JOIN (SELECT * FROM unit_known WHERE source = 'grid') AS g USING (bmu_id)
LEFT JOIN (SELECT * FROM unit_known WHERE source = 'station') AS p USING (bmu_id)
LEFT JOIN (SELECT bmu_id,
    bool_or(type_code = 'ALLNOTIFY') OR NULL AS all_notify, bool_or(type_code = 'NOTIFYNOTSVA') OR NULL AS notify_not_sva,
    bool_or(type_code = 'NOTIFYCVA') OR NULL AS notify_cva, bool_or(type_code = 'NOTIFYSVA') OR NULL AS notify_sva,
    bool_or(type_code = 'EMBEDDEDCVA') OR NULL AS embedded_cva, bool_or(type_code = 'DIRECTCONCVA') OR NULL AS directcon_cva,
    bool_or(type_code = 'INTERCONS') OR NULL AS intercons, bool_or(type_code = 'SVAONLY') OR NULL AS sva_only
  FROM unit_known WHERE source = 'class' GROUP BY bmu_id) AS c USING (bmu_id)
LEFT JOIN (SELECT bmu_id, avg(generation_capacity) AS generation_capacity, avg(demand_capacity) AS demand_capacity
  FROM unit_known GROUP BY bmu_id) AS m USING (bmu_id)""",
    "source_units": """
SELECT b.bmunit AS bmu_id, substr(b.bmunit, 1, 2) AS player, b.bscparty AS bsc_party, n.ngcbmunitid AS ngc_bmu_id,
  n.ngcbmunitid IS NOT NULL AS ngc_bmu_flag,
  b.effectivefromdate = max(b.effectivefromdate) OVER (PARTITION BY b.bmunit) AS last_flag,
  b.effectivetodate IS NULL AS currently_active, CAST(b.effectivefromdate AS DATE) AS effective_from_date,
  CAST(b.effectivetodate AS DATE) AS effective_to_date, s.generation_capacity, s.demand_capacity,
  n.name AS enapp_name, n.fueltype AS enapp_class, s.neta_type, fn.fuel_name AS neta_name, s.ngc_type,
  gn.grid_name AS ngc_name, s.power_station_id, st.power_station_name,
  s.all_notify, s.notify_not_sva, s.notify_cva, s.notify_sva, s.embedded_cva, s.directcon_cva, s.intercons, s.sva_only
FROM raw_party AS b LEFT JOIN unit_source_rows AS s ON s.bmu_id = b.bmunit
LEFT JOIN raw_unit_names AS n ON n.bmunitid = b.bmunit
LEFT JOIN fuel_names AS fn ON fn.code = s.neta_type LEFT JOIN grid_names AS gn ON gn.code = s.ngc_type
LEFT JOIN raw_station AS st ON st.power_station_id = s.power_station_id""",
    "fuel_names": """
SELECT * FROM (VALUES ('CHEMICAL', 'Chemical Works Demand'), ('DEMAND', 'Demand'), ('RAIL', 'Railway Demand'),
  ('STEEL', 'Steelworks Demand'), ('WIND', 'Wind'), ('SVA_A', 'SVA Container - Eastern GSP Group'),
  ('SVA_C', 'SVA Container - London GSP Group'), ('BATTERY', 'Electro-Chemical Battery'),
  ('CCGT', 'Combined Cycle Gas Turbine')) AS v(code, fuel_name)""",
    "grid_names": """
SELECT * FROM (VALUES ('BATTERY', 'Battery'), ('WIND', 'Wind'), ('COAL', 'Coal'), ('PS', 'Pumped Storage'))
  AS v(code, grid_name)""",
    "source_units_matched": """
SELECT u.*, r.fpn_flag, r.bm_unit_id IS NOT NULL AS matched
FROM source_units AS u LEFT JOIN raw_bm_units AS r ON r.bm_unit_id = u.bmu_id""",
    "merged_units": f"""
SELECT * EXCLUDE (fpn_flag, matched, embedded_cva, directcon_cva, intercons, sva_only, all_notify, notify_not_sva,
    notify_cva, notify_sva),
  {flag('embedded_cva', "'E_'")}, {flag('directcon_cva', "'T_', 'M_'")}, {flag('intercons', "'I_'")},
  {flag('sva_only', "'2_'")},
  CASE WHEN matched AND all_notify IS NULL THEN coalesce(fpn_flag <> 'F', TRUE) ELSE all_notify END AS all_notify,
  {notify('notify_not_sva', "'C_', 'E_', 'I_', 'M_', 'T_', 'V_'")}, {notify('notify_cva', "'T_', 'E_', 'M_'")},
  {notify('notify_sva', "'2_'")}
FROM source_units_matched""",
})

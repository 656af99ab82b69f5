"""Settlement-shaped inputs, as SQL over the given tables.

One text for Spark and for DuckDB. The given tables have no settlement data, so
reports come from `lineitem`, units from `supplier`, stations from `nation` and
reference factors from the dates, areas and codes that occur in `lineitem`.
All of them grow with the tables.
"""

# A sixth of the readings arrive as exact copies, as when a file is sent twice.
READINGS = """
SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'R'
"""

DAY = "(DATE '2020-03-25' + CAST({key} % 21 AS INT))"
TEXT_DAY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS STRING)"
RUN = (
    "CASE l_linenumber WHEN 1 THEN 'II' WHEN 2 THEN 'SF' WHEN 3 THEN 'R1' WHEN 4 THEN 'R2'"
    " WHEN 5 THEN 'R3' WHEN 6 THEN 'RF' ELSE 'DF' END"
)
AREA = "'_' || substr('ABCDEFGHJKLMNP', CAST({z} AS INT) + 1, 1)"
PERIOD = "CAST((l_orderkey * 7 + l_partkey) % 48 + 1 AS INT)"
UNIT = "substr('T_E_M_2_C_I_V_', CAST({k} % 7 AS INT) * 2 + 1, 2) || 'BMU' || CAST({k} AS STRING)"

_date = DAY.format(key="l_orderkey")
_zpd = TEXT_DAY.format(d=_date)
_filed = TEXT_DAY.format(
    d="(DATE '2020-03-25' + CAST(l_orderkey % 21 + l_linenumber * 30 AS INT))"
)
_area = AREA.format(z="l_suppkey % 14")
_unit = UNIT.format(k="l_suppkey")
_supplier_unit = UNIT.format(k="s_suppkey")
# Profiled rows fall on six days of four weeks: clock change, a Sunday, a holiday,
# both years. With more orders there are more such weeks.
_profiled = "CAST((l_orderkey % 6) * 4 + 28 * floor(l_orderkey / 200000) AS INT)"
# Days and areas of all reports, as the reference factors have them.
_DAYS_AREAS = f"""(SELECT DISTINCT CAST(l_orderkey % 21 AS INT) AS i, l_suppkey % 14 AS z FROM lineitem
  UNION SELECT DISTINCT {_profiled}, l_suppkey % 14 FROM lineitem) AS g"""
# Loss classes: four, and four more with every 5,000 parts.
_loss_class = "CAST(l_partkey % 4 + 4 * floor(l_partkey / 5000) AS INT)"
_profiled_day = f"(DATE '2020-03-25' + {_profiled})"
_profiled_zpd = TEXT_DAY.format(d=_profiled_day)
_profiled_filed = TEXT_DAY.format(
    d=f"(DATE '2020-03-25' + CAST({_profiled} + l_linenumber * 30 AS INT))"
)
_i_day = "(DATE '2020-03-25' + CAST(i AS INT))"

_CLASS = (
    "CASE s_suppkey % 10 WHEN 0 THEN 'CHEMICAL' WHEN 1 THEN 'DEMAND' WHEN 2 THEN 'RAIL'"
    " WHEN 3 THEN 'STEEL' WHEN 4 THEN 'WIND' WHEN 5 THEN 'SVA_A' WHEN 6 THEN 'SVA_C'"
    " WHEN 7 THEN 'BATTERY' WHEN 8 THEN 'CCGT' ELSE NULL END"
)
_EVERY_FOURTH_TWICE = "(VALUES (0), (1)) AS w(v) ON v = 0 OR s_suppkey % 4 = 0"

_PERIOD_COEFFICIENTS = ",\n  ".join(
    f"CASE WHEN i = 4 AND {k} > 46 OR {k} > 48 THEN NULL"
    f" ELSE (1 + (p * {k} + z + x + t + i) % 17) / 1e3 END AS ppc_{k}"
    for k in range(1, 51)
)

VIEWS = {
    "readings": READINGS,
    "raw_d276": f"""
SELECT {_zpd} AS zpd, {_filed} || '_P0276' AS pool, {RUN} AS hdr, {_area} AS gsp,
  CAST(l_partkey % 66 + 1 AS INT) AS ccc, {PERIOD} AS spx,
  CAST(l_extendedprice AS STRING) AS a, CAST(l_quantity AS STRING) AS h,
  CASE WHEN l_tax = 0.08 AND l_discount = 0 THEN NULL ELSE CAST(l_extendedprice AS STRING) END AS m,
  CAST(l_quantity AS STRING) AS c, CAST(l_quantity AS INT) AS ai
FROM readings""",
    "raw_d277": f"""
SELECT {_profiled_zpd} AS zpd, {_profiled_filed} || '_P0277' AS pool, {RUN} AS hdr, {_area} AS gsp,
  CAST(l_partkey % 9 + 1 AS STRING) AS a, 'S' || CAST(l_suppkey % 3 AS STRING) AS b,
  CAST(100 + {_loss_class} AS STRING) AS c, 'DNO' || CAST(l_suppkey % 2 AS STRING) AS d,
  CAST(l_orderkey % 2 + 1 AS STRING) AS e,
  CASE WHEN l_tax = 0.08 AND l_discount = 0 THEN 'n/a' ELSE CAST(l_extendedprice AS STRING) END AS f,
  CAST(l_quantity AS STRING) AS g,
  CAST(l_extendedprice * (l_linenumber % 3) AS STRING) AS h, CAST(l_quantity AS STRING) AS i,
  CAST(l_quantity * 10 AS STRING) AS j, CAST(l_linenumber AS STRING) AS k,
  '0' AS l, '0' AS m
FROM readings""",
    # Two runs for every key; the clock-change day (i = 4) has 46 periods.
    "raw_tlm": f"""
SELECT {_i_day} AS settlement_date,
  CASE WHEN k = 0 THEN 'II' WHEN i < 10 THEN 'DF' ELSE 'SF' END AS settlement_run_type,
  CAST(sp AS INT) AS settlement_period, CAST(z + 1 AS INT) AS zone,
  0.98e0 - k / 1e2 + ((i * 7 + sp * 3 + z * 5) % 11) / 1e3 AS off_taking,
  CASE WHEN (i + sp + z) % 13 = 0 THEN 0e0 ELSE 1.01e0 END AS delivering
FROM {_DAYS_AREAS}
CROSS JOIN range(1, 49) AS s(sp) CROSS JOIN (VALUES (0), (1)) AS r(k)
WHERE NOT (i = 4 AND sp > 46)""",
    "tlm_rows": f"""
SELECT settlement_date, settlement_run_type, settlement_period, off_taking,
  CASE WHEN delivering = 0 THEN 1e0 ELSE delivering END AS delivering,
  {AREA.format(z="zone - 1")} AS gsp_area
FROM raw_tlm""",
    "raw_gcf": f"""
SELECT {AREA.format(z="z")} AS gsp_area, {_i_day} AS settlement_date, 'SF' AS run_type,
  CAST(sp AS INT) AS settlement_period, 0.95e0 + ((i + sp + z) % 10) / 1e2 AS gcf
FROM {_DAYS_AREAS}
CROSS JOIN range(1, 49) AS s(sp)
WHERE NOT (i = 4 AND sp > 46)""",
    "raw_pc": f"""
SELECT CAST(p AS STRING) AS profile_class_id, {AREA.format(z="z")} AS gsp_group_id,
  'S' || CAST(x AS STRING) AS std_settlement_config_id,
  '0' || CAST(t AS STRING) AS time_pattern_regime_id, {_i_day} AS settlement_date,
  {_PERIOD_COEFFICIENTS}
FROM (SELECT DISTINCT {_profiled} AS i, l_suppkey % 14 AS z, l_partkey % 9 + 1 AS p,
  l_suppkey % 3 AS x, l_orderkey % 2 + 1 AS t FROM lineitem) AS g
WHERE p < 9""",
    "raw_llf": f"""
SELECT 'DNO' || CAST(n AS STRING) AS market_participant_id, CAST(100 + c AS STRING) AS llf_class_id,
  (DATE '2020-03-25' + CAST(w * 7 AS INT)) AS start_settlement_date,
  (DATE '2020-03-25' + CAST(w * 7 + 6 AS INT)) AS end_settlement_date,
  CASE WHEN y = 0 THEN 'WD' ELSE 'NWD' END AS day_type, 1.02e0 + (n + c + w + y + b) / 1e2 AS value,
  CAST(b * 24 + 1 AS BIGINT) AS start_settlement_period, CAST(b * 24 + 24 AS BIGINT) AS end_settlement_period
FROM (SELECT DISTINCT l_suppkey % 2 AS n, {_loss_class} AS c FROM lineitem) AS g
CROSS JOIN (SELECT DISTINCT CAST(floor(i / 7) AS INT) AS w FROM {_DAYS_AREAS}) AS k
CROSS JOIN (VALUES (0), (1)) AS d(y) CROSS JOIN (VALUES (0), (1)) AS h(b)""",
    "raw_holiday": f"""
SELECT DISTINCT day AS holiday_date, label FROM (SELECT {DAY.format(key="o_orderkey")} AS day FROM orders) AS o
JOIN (VALUES (DATE '2020-04-10', 'Good Friday'), (DATE '2020-04-13', 'Easter Monday [England/Wales/Northern Ireland]'),
  (DATE '2020-04-13', 'Easter Monday'), (DATE '2020-04-01', 'Spring Day [Scotland]'),
  (DATE '2020-04-02', 'Founders Day [Northern Ireland]'),
  (DATE '2020-03-26', 'New Year''s Day (substitute) [Scotland]')) AS h(on_day, label) ON day = on_day""",
    "raw_c042": f"""
SELECT 'C0421' AS dataflowid, CAST(l_suppkey AS STRING) AS cdcarunnumber, CAST(l_shipdate AS STRING) AS dateofaggregation,
  CAST(l_linenumber AS STRING) AS inserteddate, {_unit} AS bmunitid, {_date} AS settlementdate, {RUN} AS settlementruntype,
  CAST({PERIOD} AS STRING) AS settlementperiod, l_returnflag = 'A' AS estimateindicator,
  CASE WHEN l_linestatus = 'O' THEN 'I' ELSE 'E' END AS importexportindicator,
  CAST(l_quantity AS STRING) AS metervolume
FROM readings""",
    "raw_s014": f"""
SELECT {_unit} AS bmunitid, {_date} AS settlementdate, {RUN} AS settlementruntype,
  {PERIOD} AS settlementperiod, 'TU' || CAST(l_partkey AS STRING) AS tradingunitname,
  CAST(l_quantity AS STRING) AS periodfpn,
  CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN NULL
    ELSE CAST(l_quantity - 20 AS STRING) END AS bmunitmeteredvolume,
  CAST(1 - l_tax / 10 AS STRING) AS transmissionlossmultiplier,
  CAST(l_discount AS STRING) AS bmunitapplicablebalancingservicesvolume
FROM readings""",
    "raw_bmu": f"""
SELECT {_supplier_unit} AS bmu_id, 'PARTY' || CAST(s_nationkey AS STRING) AS bsc_party,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'NGC' || CAST(s_suppkey AS STRING) END AS ngc_bmu_id,
  s_name AS enapp_name, 'Type ' || CAST(s_suppkey % 6 AS STRING) AS ngc_name, {_CLASS} AS enapp_class,
  CASE WHEN v = 0 THEN DATE '2016-01-01' ELSE DATE '2019-01-01' END AS effective_from_date,
  CASE WHEN v = 0 AND s_suppkey % 4 = 0 THEN DATE '2018-12-31' ELSE NULL END AS effective_to_date,
  CASE WHEN s_suppkey % 5 < 2 THEN TRUE ELSE NULL END AS all_notify,
  CASE WHEN s_suppkey % 7 = 3 THEN TRUE ELSE NULL END AS notify_not_sva,
  CASE WHEN s_suppkey % 7 = 5 THEN FALSE ELSE NULL END AS notify_cva,
  CAST(NULL AS BOOLEAN) AS notify_sva,
  CASE WHEN s_suppkey % 11 = 0 THEN TRUE ELSE NULL END AS embedded_cva,
  CASE WHEN s_suppkey % 13 = 0 THEN TRUE ELSE NULL END AS directcon_cva,
  CASE WHEN s_suppkey % 17 = 0 THEN TRUE ELSE NULL END AS intercons,
  CASE WHEN s_suppkey % 19 = 0 THEN TRUE ELSE NULL END AS sva_only
FROM supplier JOIN {_EVERY_FOURTH_TWICE}""",
    # All suppliers; some have an id and nothing else.
    "listed_units": f"""
SELECT {_supplier_unit} AS bm_unit_id, CASE WHEN s_suppkey % 9 > 0 THEN s_name END AS bmu_name,
  CASE WHEN s_suppkey % 9 > 0 THEN 'PARTY' || CAST(s_nationkey AS STRING) END AS party_id,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'T' ELSE 'F' END AS fpn_flag
FROM supplier""",
    # A dictionary is merged with the units of one list, which lacks some.
    "raw_bm_units": f"""
SELECT {_supplier_unit} AS bm_unit_id, s_name AS bmu_name, 'PARTY' || CAST(s_nationkey AS STRING) AS party_id,
  CASE WHEN s_suppkey % 2 = 0 THEN 'T' ELSE 'F' END AS fpn_flag
FROM supplier WHERE s_acctbal > 1000""",
    "raw_party": f"""
SELECT {_supplier_unit} AS bmunit, 'PARTY' || CAST(s_nationkey AS STRING) AS bscparty,
  CASE WHEN v = 0 THEN '2016-01-01' ELSE '2019-01-01' END AS effectivefromdate,
  CASE WHEN v = 0 AND s_suppkey % 4 = 0 THEN '2018-12-31' ELSE NULL END AS effectivetodate
FROM supplier JOIN {_EVERY_FOURTH_TWICE}""",
    "raw_unit_names": f"""
SELECT {_supplier_unit} AS bmunitid, s_name AS name, {_CLASS} AS fueltype,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'NGC' || CAST(s_suppkey AS STRING) END AS ngcbmunitid
FROM supplier""",
    # The lists as payloads: day-first dates among ISO ones, and a second record
    # for some units that must not mix with the first.
    "raw_party_xml": """
SELECT '<response><bmunitforbscparty bmunit="' || bmunit || '" bscparty="' || bscparty || '" effectivefromdate="'
  || CASE WHEN effectivefromdate = '2016-01-01' THEN '01/01/2016' ELSE effectivefromdate END || '"'
  || coalesce(' effectivetodate="' || CASE WHEN effectivetodate = '2018-12-31' THEN '31/12/2018' ELSE effectivetodate END || '"', '')
  || '/></response>' AS payload FROM raw_party""",
    "raw_names_xml": """
SELECT '<response><bmunit bmunitid="' || bmunitid || '" name="' || name || '"'
  || coalesce(' fueltype="' || fueltype || '"', '') || coalesce(' ngcbmunitid="' || ngcbmunitid || '"', '') || '/>'
  || CASE WHEN fueltype = 'WIND' THEN '<bmunit bmunitid="' || bmunitid || '" name="A former name" fueltype="ZZ" ngcbmunitid="ZZ"/>' ELSE '' END
  || '</response>' AS payload FROM raw_unit_names""",
    "raw_station": """
SELECT 'PS' || CAST(n_nationkey AS STRING) AS power_station_id, n_name AS power_station_name FROM nation""",
    "unit_types": f"""
SELECT 'fuel' AS source, coalesce({_CLASS}, 'OTHERFUEL') AS type_code, {_supplier_unit} AS bmu_id,
  s_suppkey AS base, s_suppkey AS dc_base FROM supplier
UNION ALL
SELECT 'grid', CASE s_suppkey % 6 WHEN 0 THEN 'BATTERY' WHEN 1 THEN 'WIND' WHEN 2 THEN 'NA' WHEN 3 THEN 'COAL'
  WHEN 4 THEN 'PS' ELSE 'NEWTYPE' END, {_supplier_unit}, s_suppkey + 3, s_suppkey FROM supplier
UNION ALL
SELECT 'station', 'PS' || CAST(s_nationkey AS STRING), {_supplier_unit}, s_suppkey + 5, s_suppkey + 1 FROM supplier
UNION ALL
SELECT 'class', code, {_supplier_unit}, s_suppkey + k,
  CASE WHEN k = 3 AND s_nationkey > 12 THEN NULL ELSE s_suppkey END
FROM supplier JOIN (VALUES (0, 'ALLNOTIFY'), (1, 'NOTIFYNOTSVA'), (2, 'NOTIFYCVA'), (3, 'NOTIFYSVA'),
  (4, 'EMBEDDEDCVA'), (5, 'DIRECTCONCVA'), (6, 'INTERCONS'), (7, 'SVAONLY')) AS c(k, code)
  ON (s_suppkey + k) % 5 = 0""",
    "raw_unit_xml": """
SELECT source, type_code,
  '<response><settlementdate settlementdate="20200401"><bmunit bmunitid="' || bmu_id || '">'
  || '<settlementperiod settlementperiod="1" gc="' || CAST(base * 10 AS STRING) || '"'
  || coalesce(' dc="' || CAST(dc_base AS STRING) || '"', '') || '/>'
  || '<settlementperiod settlementperiod="2" gc="' || CAST(base * 20 AS STRING) || '"'
  || coalesce(' dc="' || CAST(dc_base + 2 AS STRING) || '"', '') || '/>'
  || '</bmunit></settlementdate></response>' AS payload
FROM unit_types""",
}

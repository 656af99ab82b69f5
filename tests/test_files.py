"""Landed files as they really arrive: other layouts, extra columns, several date forms, faults."""

import datetime as dt

import pytest

from settle import session
from settle.checks.inputs import fresh_schema
from settle.checks.registry import Inputs
from settle.operators import rejects, runs
from settle.functions.flags import run_rank
from settle.functions.text import any_date, period
from settle.plans import c042, d276, tables, units
from settle.plans.tables import Store
from settle.sources import files, xml

FOLDER = "/root/testdata/sf0.001"
DAY = dt.date(2020, 4, 1)


def land(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_columns_are_found_by_name_in_each_file(spark, tmp_path):
    names = "GSP_GROUP_ID,SETTLEMENT_DATE,SSR_RUN_TYPE,SETTLEMENT_PERIOD,GSP_GROUP_CORRECTION_FACTOR"
    land(tmp_path, "a.csv", f"{names}\n_A,2020-04-01,SF,1.0,0.9\n")
    land(tmp_path, "deep/b.csv", 'Remark,settlement_date,gsp_group_id,GSP Group Correction Factor,SETTLEMENT_PERIOD,SSR_RUN_TYPE\n"x, y",01/04/2020,_B,1.1,2,II\n')
    rows = sorted(map(tuple, files.load_gcf(spark, str(tmp_path)).collect()))
    assert rows == [("_A", DAY, "SF", 1, 0.9), ("_B", DAY, "II", 2, 1.1)]


def test_missing_column_fails(spark, tmp_path):
    land(tmp_path, "a.csv", "GSP_GROUP_ID,SETTLEMENT_DATE,SSR_RUN_TYPE,SETTLEMENT_PERIOD\n_A,2020-04-01,SF,1\n")
    with pytest.raises(ValueError, match="gsp_group_correction_factor"):
        files.load_gcf(spark, str(tmp_path))


def test_odd_names_and_quoted_headers(spark, tmp_path):
    land(tmp_path, "my file.csv", "a,b\n1,x\n")
    land(tmp_path, "100%20 sure/other.csv", '\ufeff"b","c, or d",a\r\n"y, z",9,2\r\n\r\n')
    land(tmp_path, "blank first.csv", '\n"a",b,"q ""r"""\n3,w,0\n')
    land(tmp_path, "empty.csv", "")
    land(tmp_path, "header only.csv", "b,a\n")
    made = files.scan_csv_many(spark, str(tmp_path), "a int, b string")
    assert sorted(map(tuple, made.collect())) == [(1, "x"), (2, "y, z"), (3, "w")]
    alone = tmp_path / "alone"
    land(alone, "one % two.csv", 'a,"x, y",b\n5,0,v\n')
    assert [tuple(r) for r in files.scan_csv_many(spark, str(alone), "a int, b string").collect()] == [(5, "v")]
    land(tmp_path, "nothing/none.csv", "")
    with pytest.raises(ValueError, match="no CSV"):
        files.scan_csv_many(spark, str(tmp_path / "nothing"), "a int")


@pytest.mark.parametrize("layouts", [1, 3])
def test_a_thousand_files_are_one_scan(spark, tmp_path, layouts):
    headers = ["a,b,c", "c,b,a", 'b,a,"c"']
    for i in range(1000):
        header = headers[i % layouts]
        row = {"a": str(i), "b": f'"b, {i}"', "c": "x"}
        land(tmp_path, f"{i % 7}/f {i}.csv", header + "\n" + ",".join(row[n.strip('"')] for n in header.split(",")) + "\n")
    made = files.scan_csv_many(spark, str(tmp_path), "a int, b string")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") + plan.count("FileScan text") == 1
    assert sorted(map(tuple, made.collect())) == [(i, f"b, {i}") for i in range(1000)]


REPORT = "zpd string, pool string, hdr string, gsp string, ccc string, spx string, a string, h string, m string, c string, ai long"


def reading(zpd, spx="1"):
    return (zpd, "20200402", "SF", "_A", "1", spx, "1", "1", "1", "1", 1)


def test_report_dates_are_read_or_fail(spark):
    good = spark.createDataFrame([reading("20200401"), reading("2020-04-01"), reading("01/04/2020"), reading(None)], REPORT)
    assert [r.date for r in d276.parse(good).collect()] == [DAY, DAY, DAY, None]
    for bad in (reading("1st April"), reading("20200401", "one"), reading("20201301")):
        with pytest.raises(Exception, match="no known form of date|no settlement period"):
            d276.parse(spark.createDataFrame([bad], REPORT)).collect()
    s014_rows = spark.createDataFrame([("T_A", "2020-04-01", "x")], "bmunitid string, settlementdate string, settlementperiod string")
    with pytest.raises(Exception, match="no settlement period: x"):
        s014_rows.select(period("settlementperiod")).collect()


def test_rejects_are_listed_bounded_and_set_aside(spark, tmp_path):
    raw = spark.createDataFrame([reading("20200401"), reading("soon"), reading("", "3"), reading("later", "two")], REPORT)
    listed = {r.zpd: r.unreadable for r in rejects.rejected(raw, d276.READABLE).collect()}
    assert listed == {"soon": ["zpd"], "later": ["zpd", "spx"]}
    assert d276.parse(rejects.admitted(raw, d276.READABLE)).count() == 2
    store = Store(spark, str(tmp_path))
    for name in tables.REPORTS:
        store.save(raw if name == "p315" else spark.createDataFrame([], ", ".join(f"{c} string" for c in tables.REPORTS[name])), name)
    with pytest.raises(ValueError, match="p315: 2 rows cannot be read, 1 are allowed"):
        tables.admitted_rows(store, 1)
    assert tables.admitted_rows(store, 2)["p315"].count() == 2 and store.read("p315_rejects").count() == 2


DAY_XML = '<response><settlementdate settlementdate="20200401">{}</settlementdate></response>'
UNIT_XML = '<bmunit bmunitid="T_A"><settlementperiod settlementperiod="1" gc="2.0" dc="-1.0"/></bmunit>'


@pytest.mark.parametrize("text", [DAY_XML.format(UNIT_XML)[:-30], "no xml at all", "", DAY_XML.format(UNIT_XML) + "tail", "{}"])
def test_malformed_payloads_fail_or_are_listed(spark, text):
    rows = [("fuel", DAY_XML.format(UNIT_XML)), ("grid", text), ("class", DAY_XML.format("")), ("none", None), ("bare", "<response/>\n")]
    payloads = spark.createDataFrame(rows, "source string, payload string")
    with pytest.raises(Exception, match="malformed payload"):
        xml.parse_unit_xml(payloads).collect()
    assert [r.source for r in xml.malformed_payloads(payloads).collect()] == ["grid"]
    read = xml.parse_unit_xml(xml.readable_payloads(payloads)).collect()
    assert [(r.source, r.settlement_date, r.bmu_id, r.gc) for r in read] == [("fuel", DAY, "T_A", 2.0)]
    for parse in (xml.parse_party_list, xml.parse_unit_list):
        with pytest.raises(Exception, match="malformed payload"):
            parse(payloads.select("payload")).collect()


def test_stored_tables_are_measured_without_a_job(spark, tmp_path):
    spark.range(5000).selectExpr("id", "repeat('x', 50) AS text").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    side = table.where("id < 100").select("id")
    assert session.file_bytes(table) >= 5000 and session.file_bytes(side) >= 5000
    assert session.file_bytes(table.join(side, "id")) is None and session.file_bytes(spark.range(5)) is None
    spark.sparkContext.setJobGroup("measured", "no job")
    session.bounded(side, within=table)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("measured")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


LLF = "DISTRIBUTOR_BUSINESS_ID,MARKET_PARTICIPANT_ID,LLF_CLASS_ID,START_SETTLEMENT_DATE,END_SETTLEMENT_DATE,DAY_TYPE,VALUE,START_SETTLEMENT_PERIOD,END_SETTLEMENT_PERIOD\n"


def test_bad_date_fails_and_iso_dates_stay(spark, tmp_path):
    land(tmp_path, "good/a.csv", LLF + "10,D,1,2020-04-01,30/04/2020,WD,1.1,1,48\n10,D,1,,30/04/2020,WD,1.1,1,48\n")
    assert [r.start_settlement_date for r in files.load_llf(spark, str(tmp_path / "good")).collect()] == [DAY]
    land(tmp_path, "bad/a.csv", LLF + "10,D,1,first of April,30/04/2020,WD,1.1,1,48\n")
    with pytest.raises(Exception, match="first of April"):
        files.load_llf(spark, str(tmp_path / "bad")).collect()


def test_date_forms(spark):
    texts = ["2020-04-01", "01/04/2020", "1/4/2020", "20200401", "01-04-2020", "2020/04/01", " 2020-04-01 ", "2020-04-01 00:00:00"]
    rows = spark.createDataFrame([(t,) for t in texts] + [("",), (None,)], "t string")
    assert [r[0] for r in rows.select(any_date("t")).collect()] == [DAY] * len(texts) + [None, None]


def test_unit_list_by_line(spark, tmp_path):
    names = [c.replace("_", " ").strip() for c in files.BM_UNIT_COLUMNS]
    top = "Registered BM Units,2020-04-01\nnotes, with, commas\n"
    land(tmp_path, "one.csv", top + ",".join(names) + "\nT_A" + "," * 27 + '\nT_B,"Name, Ltd"' + "," * 26 + "\n\n")
    land(tmp_path, "two.txt", "x\r\n\r\n" + ",".join(names[::-1]) + "\r\n" + "," * 27 + "E_C\r\n")
    rows = {r.bm_unit_id: r.bmu_name for r in files.load_bm_units(spark, str(tmp_path)).collect()}
    assert rows == {"T_A": None, "T_B": "Name, Ltd", "E_C": None}


def test_whole_records_and_closed_units(spark):
    parties = spark.createDataFrame([
        ('<response><bmunitforbscparty bmunit="T_A" bscparty="P" effectivefromdate="01/01/2016" effectivetodate="31/12/2018"/>'
         '<bmunitforbscparty bmunit="T_B" bscparty="P" effectivefromdate="2016-01-01"/></response>',)], "payload string")
    names = spark.createDataFrame([
        ('<response><bmunit bmunitid="T_A" name="Alpha" fueltype="WIND" ngcbmunitid="N1"/>'
         '<bmunit bmunitid="T_A" name="Beta" fueltype="CCGT"/></response>',)], "payload string")
    empty = spark.createDataFrame([], "source string, type_code string, payload string")
    stations = spark.createDataFrame([], "power_station_id string, power_station_name string")
    made = units.source_dictionary(empty, xml.parse_party_list(parties), xml.parse_unit_list(names), stations)
    rows = {r.bmu_id: r for r in made.collect()}
    assert (rows["T_A"].enapp_name, rows["T_A"].enapp_class, rows["T_A"].ngc_bmu_id) == ("Beta", "CCGT", None)
    assert not rows["T_A"].currently_active and rows["T_A"].last_flag and rows["T_B"].currently_active


def test_store_by_catalog_name(spark):
    store = Store(spark, schema=fresh_schema(spark))
    store.save(spark.range(3), "numbers")
    store.save(spark.range(4), "numbers")
    assert store.read("numbers").count() == 4
    spark.sql(f"DROP DATABASE {store.schema} CASCADE")


def test_full_rows_move_once_for_the_latest_run(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = c042.parse(Inputs(spark, FOLDER).raw_c042)
        rank = run_rank("settlementruntype")
        best = runs.latest_rank(rows, runs.UNIT_DIRECTION, rank)
        kept = runs.keep_last_run(rows, best, runs.UNIT_DIRECTION, rank, distinct=True)
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_work_folder_needs_a_shared_place(monkeypatch):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session._local_folder("spark://host:7077")
    removed = []
    monkeypatch.setattr(session.atexit, "register", lambda *a, **k: removed.append(a))
    folder = session._local_folder("local[2]")
    assert removed[0][1] == folder
    removed[0][0](folder)

"""Rows at the edges of the rules, on tiny frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from settle.functions import calendar, flags, text
from settle.operators import factors, ranges, runs
from settle.plans import c042, d276, embedded, levies, s014, units
from settle.sources.codes import EXPORT_CLASSES, IMPORT_CLASSES, UNIT_CATEGORY
from settle.sources.holidays import working_calendar
from settle.sources.xml import parse_unit_xml, readable_payloads

D = dt.date


def raw276(spark, *rows):
    """Rows of (zpd, pool, hdr, gsp, ccc, spx, value)."""
    full = [(z, p, h, g, c, s, v, "1", v, "1", 2) for z, p, h, g, c, s, v in rows]
    return spark.createDataFrame(
        full, "zpd string, pool string, hdr string, gsp string, ccc int, spx int,"
        " a string, h string, m string, c string, ai int",
    )


def tlm(spark, *rows):
    return spark.createDataFrame(
        list(rows), "settlement_date date, settlement_run_type string, settlement_period int,"
        " off_taking double, delivering double, gsp_area string",
    )


ONE_TLM = (D(2020, 4, 1), "SF", 1, 0.5, 1.0, "_A")


def test_class_lists_do_not_overlap():
    assert not set(IMPORT_CLASSES) & set(EXPORT_CLASSES)
    assert len(IMPORT_CLASSES) == len(EXPORT_CLASSES) == 28
    assert len(UNIT_CATEGORY) == 62


def test_unmapped_class_decides_the_run_but_has_no_volume(spark):
    raw = raw276(
        spark,
        ("20200401", "20200501_x", "SF", "_A", 1, 1, "1000"),
        ("20200401", "20200701_x", "RF", "_A", 24, 1, "1000"),
    )
    rows = d276.demand_all_runs(raw, tlm(spark, ONE_TLM)).collect()
    assert [(r.settlement_run, r.last_run_flag) for r in rows] == [("SF", False)]


def test_copies_count_once_and_other_files_stay_apart(spark):
    row = ("20200401", "20200501_x", "SF", "_A", 1, 1, "1000")
    later = ("20200401", "20200502_x", "SF", "_A", 1, 1, "1000")
    rows = d276.demand_all_runs(raw276(spark, row, row, later), tlm(spark, ONE_TLM)).collect()
    assert [r.uncorrected_consumption_gwh for r in rows] == [1.0, 1.0]
    assert all(r.last_run_flag for r in rows)


def test_missing_multiplier_leaves_corrected_volume_open_and_total_zero(spark):
    raw = raw276(spark, ("20200401", "20200501", "SF", "_B", 1, 1, "1000"))
    row = d276.demand_all_runs(raw, tlm(spark, ONE_TLM)).first()
    assert row.corrected_consumption_gwh is None
    assert row.total_corrected_consumption_gwh == 0
    assert row.total_uncorrected_consumption_gwh == pytest.approx(1.001)


def test_bad_number_becomes_null(spark):
    raw = raw276(spark, ("20200401", "20200501", "SF", "_A", 1, 1, "n/a"))
    row = d276.demand_all_runs(raw, tlm(spark, ONE_TLM)).first()
    assert row.uncorrected_consumption_gwh is None
    assert row.total_uncorrected_consumption_gwh == pytest.approx(0.001)


def test_exports_take_the_multiplier_only_in_their_own_total(spark):
    raw = raw276(
        spark,
        ("20200401", "20200501", "II", "_A", 6, 1, "4000"),
        ("20200401", "20200501", "SF", "_A", 6, 1, "2000"),
        ("20200401", "20200501", "XX", "_A", 6, 1, "9000"),
    )
    rows = d276.exports(raw, tlm(spark, ONE_TLM)).collect()
    assert len(rows) == 1
    assert rows[0].corrected_consumption_gwh == 2.0
    assert rows[0].total_tlm_corrected_consumption_gwh == pytest.approx(2.001 * 0.5)


def test_latest_run_of_a_factor_wins(spark):
    older = (D(2020, 4, 1), "II", 1, 0.9, 1.0, "_A")
    kept = factors.loss_multipliers(tlm(spark, older, ONE_TLM, ONE_TLM)).collect()
    assert [r.off_taking for r in kept] == [0.5]


def test_unknown_run_is_never_last(spark):
    rows = spark.createDataFrame([("k", "XX"), ("k", "II"), ("q", "XX"), (None, "DF")], "k string, run string")
    rank = flags.run_rank("run")
    best = runs.latest_rank(rows, ["k"], rank)
    marked = runs.flag_last_run(rows, best, ["k"], rank)
    assert sorted((r.k or "", r.run, r.last_run_flag) for r in marked.collect()) == [
        ("", "DF", False), ("k", "II", True), ("k", "XX", False), ("q", "XX", False),
    ]
    totals = runs.flag_last_run_of_totals(rows.where("k IS NOT NULL"), ["k"], {"last": rank})
    assert sorted((r.k, r.run, r.last) for r in totals.collect()) == [
        ("k", "II", True), ("k", "XX", False), ("q", "XX", False),
    ]


def test_day_type(spark):
    labels = [
        (D(2020, 4, 10), "Good Friday"),
        (D(2020, 4, 13), "Easter Monday [England/Wales/Northern Ireland]"),
        (D(2020, 4, 13), "Easter Monday"),
        (D(2020, 4, 1), "Day [Scotland]"),
        (D(2020, 4, 2), "Day [Northern Ireland]"),
        (D(2020, 1, 2), "New Year's Day (substitute) [Scotland]"),
        (D(2020, 4, 11), "Saturday holiday"),
    ]
    days = working_calendar(spark.createDataFrame(labels, "holiday_date date, label string"))
    assert days.count() == 4
    dates = spark.createDataFrame([(D(2020, 4, n),) for n in (1, 2, 10, 11, 12, 13, 14)], "date date")
    typed = {r.date.day: r.t for r in calendar.add_day_type(dates, days, "date", "t").collect()}
    assert typed == {1: "WD", 2: "WD", 10: "NWD", 11: "NWD", 12: "NWD", 13: "NWD", 14: "WD"}


def test_financial_year_is_not_padded(spark):
    dates = spark.createDataFrame([(D(2008, 4, 1),), (D(2009, 3, 31),), (D(1999, 12, 1),)], "date date")
    assert [r[0] for r in dates.select(calendar.fin_year("date")).collect()] == ["2008-9", "2008-9", "1999-0"]


def test_to_date_flags_in_a_leap_year(spark):
    dates = spark.createDataFrame([(D(2020, 3, 1),), (D(2021, 3, 1),), (D(2019, 12, 31),)], "date date")
    got = {r.date.year: (r.ytd, r.fytd) for r in calendar.add_to_date_flags(dates).collect()}
    # 1 March is day 61 of 2020 and day 60 of 2021, the latest.
    assert got[2020][0] == 0 and got[2021][0] == 1 and got[2019][0] == 0


def test_period_start_ignores_the_clock_change(spark):
    row = spark.createDataFrame([(D(2020, 10, 25), 50)], "d date, sp int")
    assert row.select(calendar.period_start("d", "sp")).first()[0] == dt.datetime(2020, 10, 26, 0, 30)


def test_flags_of_missing_values(spark):
    row = spark.createDataFrame([(None, None)], "v double, e boolean").select(
        flags.import_export("v"), flags.actual_estimate("e"), flags.peak("v"),
        flags.missing_volume(F.col("v"), F.lit(1.0)), flags.row_mean("v", "v"),
    ).first()
    assert tuple(row) == ("import", "E", "N", 0.0, None)


def test_overlap_of_an_empty_side_is_empty(spark):
    full = spark.createDataFrame([(D(2020, 1, 1),)], "date date")
    shared = ranges.overlap(ranges.bounds(full, "date"), ranges.bounds(full.where("false"), "date"))
    assert ranges.clip(full, "date", shared).count() == 0


def bands(spark, *rows):
    return spark.createDataFrame(
        list(rows), "market_participant_id string, llf_class_id string, start_settlement_date date,"
        " end_settlement_date date, day_type string, value double,"
        " start_settlement_period bigint, end_settlement_period bigint",
    )


def test_loss_band_join_over_months_and_open_ends(spark):
    llf = bands(
        spark,
        ("D", "1", D(2000, 1, 1), D(2099, 12, 31), "WD", 1.5, 1, 2),
        ("D", "1", D(2020, 1, 15), D(2020, 2, 15), "WD", 2.0, 3, 60),
        ("D", "1", D(2020, 1, 15), D(2020, 2, 15), "WD", 9.0, 5, 4),
    )
    rows = spark.createDataFrame(
        [("D", "1", "WD", D(2020, 1, 31)), ("D", "1", "WD", D(2020, 2, 16))],
        "distributor string, loss_class string, day_type string, date date",
    )
    arrays = rows.withColumns({
        "shares": F.array(*[F.lit(0.1)] * 46, *[F.lit(None).cast("double")] * 4),
        "factors": F.array(*[F.lit(1.0)] * 50),
    })
    spread = factors.period_shares(arrays)
    joined = factors.join_loss_bands(spread, factors.loss_bands(llf, ranges.bounds(rows, "date")))
    got = factors.expand_periods(joined)
    counts = {(r.date.month, r.llf): r["count"] for r in got.groupBy("date", "llf").count().collect()}
    # Periods 47 to 50 have no share: a clock-change day.
    assert counts == {(1, 1.5): 2, (1, 2.0): 44, (2, 1.5): 2}
    low, high = got.agg(F.min("settlement_period"), F.max("settlement_period")).first()
    assert (low, high) == (1, 46)


def dictionary(spark, *rows):
    """Rows of (bmu_id, class, notify, last_flag)."""
    base = spark.createDataFrame(list(rows), "bmu_id string, enapp_class string, all_notify boolean, last_flag boolean")
    others = [c for c in units.ATTRIBUTES if c not in base.columns]
    return base.withColumns({c: F.lit(None).cast("string") for c in others})


def test_unit_without_class_or_entry_is_other(spark):
    raw = spark.createDataFrame(
        [("T_A", D(2020, 1, 1), "SF", 1, "5"), ("T_B", D(2020, 1, 1), "SF", 1, None), ("T_C", D(2020, 1, 1), "SF", 1, "-1")],
        "bmunitid string, settlementdate date, settlementruntype string, settlementperiod int, bmunitmeteredvolume string",
    ).withColumns({c: F.lit("1") for c in s014.NUMBERS if c != "bmunitmeteredvolume"})
    units_now = dictionary(spark, ("T_A", "WIND", True, True), ("T_A", "CCGT", True, False), ("T_B", None, None, True), ("T_D", "NEW", None, True))
    rows = {r.bmunitid: (r.enapp_class, r.enapp_category, r.importexportindicator) for r in s014.volumes_all_runs(raw, units_now).collect()}
    assert rows == {
        "T_A": ("WIND", "power_station", "export"),
        "T_B": ("NONE", "other", "import"),
        "T_C": ("NONE", "other", "import"),
    }


def test_big_demand_drops_rows_with_open_keys(spark):
    raw = spark.createDataFrame(
        [("T_A", D(2020, 1, 1), "SF", "33", False, "I", "500"), ("T_A", D(2020, 1, 1), "SF", "33", False, "I", "500"),
         ("T_A", D(2020, 1, 1), "SF", "33", None, "I", "7"), ("T_A", D(2014, 12, 31), "SF", "1", True, "I", "9")],
        "bmunitid string, settlementdate date, settlementruntype string, settlementperiod string,"
        " estimateindicator boolean, importexportindicator string, metervolume string",
    )
    rows = c042.big_demand(raw, dictionary(spark, ("T_A", "STEEL", None, True))).collect()
    assert [(r.actual_estimate, r.peak, r.total_corrected_consumption_gwh) for r in rows] == [("A", "P", 0.5)]


def volumes(spark, *rows):
    """Rows of (unit, period, volume, class, notify)."""
    return spark.createDataFrame(list(rows), "bmunitid string, settlementperiod int, bmunitmeteredvolume double, enapp_class string, all_notify boolean").withColumns({
        "settlementdate": F.lit("2020-04-01").cast("date"),
        "transmissionlossmultiplier": F.lit(1.0),
        "importexportindicator": flags.import_export("bmunitmeteredvolume"),
        "player": text.player("bmunitid"),
    })


def test_embedded_classes_overlap_and_complement_is_not_negative(spark):
    exports = spark.createDataFrame(
        [(D(2020, 4, 1), 1, 5.0), (D(2020, 4, 1), 2, 1.0), (D(2020, 4, 1), 3, 4.0), (D(2020, 4, 2), 1, 4.0)],
        "date date, settlement_period int, total_tlm_corrected_consumption_gwh double",
    )
    made = volumes(spark, ("E_1", 1, 1000.0, "SVA_A", None), ("2_1", 2, 2000.0, "SVA_A", True), ("2_2", 2, 500.0, "WIND", False))
    rows = embedded.embedded_generation(exports, made).collect()
    got = {(r.settlement_period, r.classification, r.all_notify): r.volume_gwh for r in rows}
    assert got == {
        (1, "sva_bmu", False): 1.0, (1, "embedded_bmu", False): 1.0, (1, "metered_gsp_exports", False): 3.0,
        (2, "sva_bmu", True): 2.0, (2, "supplier_embedded_no_cfd", False): 0.5, (2, "metered_gsp_exports", False): 0.0,
        # No unit row for this half hour: the complement is 0, not the total.
        (3, "metered_gsp_exports", False): 0.0,
    }


def scheme(spark, *rows):
    """Rows of (date, run, area, volume)."""
    base = spark.createDataFrame(list(rows), "date date, settlement_run string, gsp_area string, uncorrected_consumption_gwh double")
    fixed = {"settlement_period": F.lit(1), "aggregation_type": F.lit("N"), "description": F.lit("1"), "sector": F.lit("Domestic"),
             "actual_estimate": F.lit("A"), "peak": F.lit("N"), "uncorrected_line_loss_gwh": F.lit(0.0),
             "total_uncorrected_consumption_gwh": F.col("uncorrected_consumption_gwh")}
    return base.withColumns(fixed)


def test_scheme_limits_by_month(spark):
    day = D(2020, 2, 3)
    sf = scheme(spark, (day, "SF", "_A", 1.0), (day, "RF", "_A", 1.0))
    rest = scheme(spark, *[(day, r, "_A", 1.0) for r in ("II", "SF", "R1", "R2", "R3", "RF")], (day, "R1", None, 1.0))
    big = scheme(spark, (day, "II", "T", 1.0))
    rows = levies.ro_fit(sf, rest, big).collect()
    got = sorted((r.gsp_area, r.settlement_run, r.last_run_ro, r.last_run_fit) for r in rows)
    # February: the obligation closes after R1, the tariff after R2.
    assert got == [
        ("T", "II", True, True), ("_A", "R1", True, False), ("_A", "R2", False, True), ("_A", "SF", True, True),
    ]


def test_scheme_never_adds_rows(spark):
    day = D(2020, 4, 3)
    twice = [(day, "R3", "_A", 1.0), (day, "R3", "_A", 2.0)]
    rest = scheme(spark, *twice)
    picked = levies.chosen_runs(levies.eligible_runs(rest))
    assert picked.count() == 2


def test_notification_of_registered_units(spark):
    base = spark.createDataFrame(
        [("T_1", "T_", None), ("T_2", "T_", None), ("T_3", "T_", False), ("T_4", "T_", None), ("2_5", "2_", None)],
        "bmu_id string, player string, all_notify boolean",
    ).withColumns({c: F.lit(None).cast("boolean") for c in ("notify_not_sva", "notify_cva", "notify_sva", "embedded_cva", "directcon_cva", "intercons", "sva_only")})
    listed = spark.createDataFrame([("T_1", "F"), ("T_2", None), ("T_3", "T"), ("2_5", "T"), ("2_5", "T")], "bm_unit_id string, fpn_flag string")
    rows = {r.bmu_id: r for r in units.unit_dictionary(base, listed).collect()}
    assert len(rows) == 5
    assert (rows["T_1"].all_notify, rows["T_1"].notify_cva) == (False, False)
    assert (rows["T_2"].all_notify, rows["T_2"].notify_cva, rows["T_2"].notify_sva) == (True, True, False)
    assert (rows["T_3"].all_notify, rows["T_3"].notify_cva) == (False, None)
    assert rows["T_4"].all_notify is None
    assert (rows["2_5"].notify_sva, rows["2_5"].notify_not_sva, rows["2_5"].sva_only) == (True, False, True)
    assert (rows["T_1"].directcon_cva, rows["T_1"].embedded_cva) == (True, False)


def test_payload_with_several_units_and_a_broken_one(spark):
    good = (
        '<response><settlementdate settlementdate="20200401"><bmunit bmunitid="A">'
        '<settlementperiod settlementperiod="1" gc="1" dc="2"/><settlementperiod settlementperiod="2" gc="3"/></bmunit>'
        '<bmunit bmunitid="B"><settlementperiod settlementperiod="1" gc="5" dc="6"/></bmunit></settlementdate></response>'
    )
    payloads = spark.createDataFrame([("fuel", "WIND", good), ("fuel", "GAS", "<html>no data"), ("fuel", "OIL", None)], "source string, type_code string, payload string")
    rows = parse_unit_xml(readable_payloads(payloads)).collect()
    assert sorted((r.bmu_id, r.settlement_period, r.gc, r.dc) for r in rows if r.bmu_id == "B") == [("B", 1, 5.0, 6.0)]
    assert sorted((r.settlement_period, r.gc, r.dc) for r in rows if r.bmu_id == "A") == [(1, 1.0, 2.0), (2, 3.0, None)]
    assert {r.type_code for r in rows} == {"WIND"}

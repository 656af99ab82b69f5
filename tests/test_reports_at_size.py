"""Reports of large tables: whole rows, and little that is moved for them."""

import pytest

from settle.checks import inputs
from settle.checks.all_queries import QUERIES
from settle.checks.registry import REPORTS, Inputs
from settle.operators import factors, measures
from settle.plans import d277

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_the_flows_are_returned_singly(spark):
    """Neither summed over nor cut down to some columns' groups."""
    assert QUERIES["proj_replicate"](spark, FOLDER).count() == QUERIES["flow_big_demand"](spark, FOLDER).count()
    nonzero = QUERIES["filter_nonzero"](spark, FOLDER)
    assert "settlement_period" in nonzero.columns
    assert nonzero.count() == QUERIES["flow_d277"](spark, FOLDER).count()


@pytest.fixture
def many_blocks(tmp_path, spark):
    for name, parts in {"lineitem": 16, "orders": 1, "supplier": 1, "nation": 1}.items():
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        rows.repartition(parts).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_reports_of_many_blocks_are_stored_as_they_are_dealt(spark, many_blocks):
    few, many = Inputs(spark, FOLDER), Inputs(spark, many_blocks)
    assert {"raw_d276", "raw_d277", "raw_c042", "raw_s014"} == REPORTS
    for name in REPORTS:
        assert "Exchange" in plan(few._spread(name, few._plan(name)))
        assert "Exchange" not in plan(many._spread(name, many._plan(name)))
    stored = [sorted(map(repr, t.raw_d277.collect())) for t in (few, many)]
    assert stored[0] == stored[1]


def test_reports_of_few_large_blocks_are_stored_without_a_shuffle(spark, tmp_path):
    """A block that is read by one task can hold any number of rows."""
    rows = spark.sql(
        "SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 5 AS l_suppkey, CAST(id % 7 + 1 AS INT) AS l_linenumber,"
        " 2e0 AS l_quantity, 3e0 AS l_extendedprice, 0e0 AS l_discount, 0e0 AS l_tax, 'R' AS l_returnflag,"
        " IF(id % 10 = 0, 'F', 'O') AS l_linestatus, DATE '1995-01-01' AS l_shipdate FROM range(0, 1100000, 1, 1)"
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("orders", "supplier", "nation"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    t = Inputs(spark, str(tmp_path))
    for name in REPORTS:
        assert "Exchange" not in plan(t._spread(name, t._plan(name)))
    found = {r.profile_class: (r.sector, r.n) for r in QUERIES["join_sector"](spark, str(tmp_path)).collect()}
    assert set(found) == set(range(1, 8)) and sum(n for _, n in found.values()) == 1_210_000
    assert {c for c, (sector, _) in found.items() if sector == "Domestic"} == {1, 2}


def test_profile_rows_are_counted_before_they_grow(spark):
    text = plan(QUERIES["join_profile_coef"](spark, FOLDER))
    grown = text.index("Generate posexplode")
    assert "HashAggregate" in text[grown:]
    assert "partial_count(1)" in text[grown:] and "partial_count(1)" not in text[:grown]


def test_conditions_do_not_repeat_the_reading_of_dates(spark):
    t = Inputs(spark, FOLDER)
    for df in (d277.complete_rows(d277.parse(t.raw_d277)), d277.parse(t.raw_d277).where("date IS NOT NULL AND settlement_run = 'SF'")):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in text.splitlines() if "Filter" in line]
        assert filters and not any("gettimestamp" in line or "concat_ws" in line for line in filters)
    # Conditions on other columns still reach the scan.
    assert any("hdr" in line and "SF" in line for line in filters)


def test_loss_classes_are_summed_before_they_grow(spark):
    """Two classes and distributors of one profile make the half hours of one."""
    t = Inputs(spark, FOLDER)
    grown = inputs.d277_half_hours(t)
    assert grown.count() == grown.select(*d277.BAND_KEYS[:-2], "settlement_period").distinct().count()
    sums = measures.profile_volumes(
        spark.createDataFrame([(1000.0, 200.0, 500.0, 50.0, 0.5, 0.9)], "f double, f_lost double, j double, j_lost double, pc double, factor double"),
        {"estimate": ["f", "j"]},
    ).first()
    assert sums.estimate_gwh == pytest.approx(0.75) and sums.corrected_estimate_loss_gwh == pytest.approx(0.1125)


def test_an_unreadable_date_fails_only_where_it_is_used(spark):
    fields = ["zpd", "pool", "hdr", "gsp", *"abcdefghijklm"]
    raw = spark.createDataFrame([("abc", "20200401_P", "SF", "_A", *["1"] * 13)], ", ".join(f"{c} string" for c in fields))
    rows = d277.parse(raw)
    assert rows.groupBy("profile_class").count().count() == 1
    with pytest.raises(Exception, match="no known form of date"):
        rows.select("date").collect()


def test_profiled_rows_are_moved_once(spark):
    """Copies, annual figures and half hours are all put together where the rows were dealt to."""
    t = Inputs(spark, FOLDER)
    for df in (inputs.d277_all(t), inputs.d277_hh(t), inputs.d277_half_hours(t)):
        text = plan(df)
        moved = [line for line in text.splitlines() if "Exchange hashpartitioning(date" in line and "profile_class" in line]
        assert len(moved) == 1 and "REPARTITION_BY_COL" in moved[0]


def test_only_loss_factors_of_classes_in_use_are_joined(spark):
    """Each class on every date is listed; a report refers to few of them."""
    rows = spark.sql("SELECT 'D' AS distributor, '1' AS loss_class, DATE '2020-04-05' AS date UNION ALL SELECT 'D', NULL, NULL")
    llf = spark.sql(
        "SELECT 'D' AS market_participant_id, CAST(id AS STRING) AS llf_class_id, DATE '2020-03-01' AS start_settlement_date,"
        " DATE '2020-12-31' AS end_settlement_date, 'WD' AS day_type, 1 AS start_settlement_period,"
        " 48 AS end_settlement_period, 1.1e0 AS value FROM range(1000)"
    )
    limits = spark.sql("SELECT DATE '2020-03-01' AS min_date, DATE '2020-12-31' AS max_date")
    used = d277.classes_in_use(rows)
    bands = factors.loss_bands(llf, limits)
    assert bands.count() == 10_000
    kept = factors.bands_in_use(bands, used).collect()
    assert [(r.loss_class, str(r.month)) for r in kept] == [("1", "2020-04-01")]

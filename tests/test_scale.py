"""Plans and results that must hold when data is large or skewed."""

import pytest
from pyspark.sql import functions as F

from settle.checks import inputs
from settle.checks.compare import spark_rows
from settle.checks.registry import Inputs
from settle.functions.flags import run_rank
from settle.operators import runs
from settle.plans import c042, d276, d277, s014
from settle.session import SIDES, bounded, offered, size_of
from settle.sources.tables import scan_table, sink_table

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def explained(df) -> str:
    util = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return util.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def no_broadcast(spark):
    """As if no side were small enough to send around."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("settle.broadcastBytes", "0")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.unset("settle.broadcastBytes")


@pytest.mark.parametrize(
    "name", ["flow_d276_last", "flow_d276_exports", "agg_daily_277", "flow_c042", "flow_s014_last", "flow_embedded"]
)
def test_same_rows_without_broadcasts(spark, no_broadcast, name):
    shuffled = spark_rows(spark, FOLDER, name)
    spark.conf.unset("settle.broadcastBytes")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert shuffled == spark_rows(spark, FOLDER, name)


def test_no_broadcast_is_hinted_for_a_large_side(spark, no_broadcast):
    rows = spark.range(100)
    assert "BroadcastHashJoin" not in plan(rows.join(bounded(spark.range(10)), "id"))


def test_sides_are_measured_in_bytes(spark):
    """Few rows may be wide; a side is offered up to its part of the limit."""
    rows = spark.range(100)
    wide = spark.range(10).withColumn("text", F.repeat(F.lit("x"), 1_000_000))
    assert 10_000_000 < size_of(wide) < 10_000_400
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, offered in ((9_000_000, False), (11_000_000, True)):
            spark.conf.set("settle.broadcastBytes", str(limit * SIDES))
            text = plan(rows.join(bounded(wide, within=wide), "id"))
            assert ("BroadcastHashJoin" in text) == offered
    finally:
        spark.conf.unset("settle.broadcastBytes")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(spark):
    t = Inputs(spark, FOLDER)
    text = explained(d276.demand_all_runs(t.raw_d276, t.tlm_rows))
    assert "In(hdr, [DF,RF,SF])" in text and "GreaterThan(ccc,8)" in text
    # The loss multiplier file is read without the columns that are not used.
    assert "delivering" not in text


def test_dates_are_filtered_in_the_scan(spark):
    tables = Inputs(spark, FOLDER)
    as_dates = c042.parse(tables.raw_c042)
    assert "GreaterThanOrEqual(settlementdate" in explained(as_dates)
    as_text = c042.parse(tables.raw_c042.withColumn("settlementdate", F.date_format("settlementdate", "dd/MM/yyyy")))
    assert as_text.exceptAll(as_dates).count() == 0 == as_dates.exceptAll(as_text).count()


def test_half_hours_are_summed_where_they_are_made(spark):
    t = Inputs(spark, FOLDER)
    text = plan(inputs.d277_all(t))
    made = text.index("Generate posexplode")
    above = text[:made]
    # Above the growth to half hours come both steps of the sum, and no exchange
    # or join in between.
    sums = [i for i, line in enumerate(above.splitlines()) if "HashAggregate(keys=[date" in line][-2:]
    between = "".join(line.split("(")[0] for line in above.splitlines()[sums[0]:])
    assert len(sums) == 2 and "Exchange" not in between and "Join" not in between


def test_raw_rows_are_never_brought_together_by_a_window(spark):
    t = Inputs(spark, FOLDER)
    for df in (inputs.exports(t), inputs.s014_last(t), inputs.d277_all(t)):
        assert "Window" not in plan(df)


def test_hot_key_holds_a_third_of_the_rows(spark):
    """One unit and period with 200,000 of 600,000 rows, copies included."""
    rows = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997 + 1).alias("u"), "id"
    )
    raw = rows.select(
        F.concat(F.lit("T_BMU"), F.col("u").cast("string")).alias("bmunitid"),
        F.lit("2020-04-01").alias("settlementdate"),
        F.element_at(F.array(*[F.lit(r) for r in ("II", "SF", "R1")]), (F.col("id") % 9 / 3 + 1).cast("int")).alias("settlementruntype"),
        F.lit(1).alias("settlementperiod"),
        *[(F.col("id") % 50).cast("string").alias(c) for c in s014.NUMBERS],
    )
    got = s014.last_run_rows(raw)
    hot = got.where("bmunitid = 'T_BMU0'")
    want = {i % 50 for i in range(0, 600_000, 3) if i % 9 // 3 == 2}
    assert {r.periodfpn for r in hot.collect()} == want
    assert hot.count() == len(want)
    best = runs.latest_rank(s014.parse(raw), runs.UNIT_PERIOD, run_rank("settlementruntype"))
    assert best.count() == 998


def test_sink_modes(spark, tmp_path):
    path = str(tmp_path / "table")
    sink_table(spark.range(3), path)
    with pytest.raises(Exception):
        sink_table(spark.range(3), path)
    sink_table(spark.range(4).withColumn("k", F.col("id") % 2), path, mode="overwrite", by=["k"])
    assert sorted(scan_table(spark, path).columns) == ["id", "k"]
    assert scan_table(spark, path, ["id"]).count() == 4


def test_daily_sums_equal_half_hours(spark):
    t = Inputs(spark, FOLDER)
    hh = inputs.d276_hh(t)
    days = inputs.d276_hh(t).transform(lambda df: df.groupBy("date").agg(F.sum("total_corrected_consumption_gwh").alias("x")))
    whole = hh.agg(F.sum("total_corrected_consumption_gwh")).first()[0]
    assert days.agg(F.sum("x")).first()[0] == pytest.approx(whole)


def test_sides_that_are_small_only_in_their_files_are_shuffled(spark, tmp_path):
    """A table of repeated values takes next to nothing on disk; what counts is its rows in memory."""
    spark.range(1_500_000).selectExpr("CAST(id % 700 AS INT) AS id", "'_A' AS gsp_area", "0.5e0 AS gcf").write.parquet(f"{tmp_path}/many")
    spark.range(5_000).selectExpr("CAST(id % 700 AS INT) AS id", "'_A' AS gsp_area", "0.5e0 AS gcf").write.parquet(f"{tmp_path}/few")
    rows = spark.range(100)
    many, few = spark.read.parquet(f"{tmp_path}/many"), spark.read.parquet(f"{tmp_path}/few")
    assert "SortMergeJoin" in plan(rows.join(offered(many, many), "id"))
    assert "BroadcastHashJoin" in plan(rows.join(offered(few, few), "id"))
    # Few rows of large arrays are as much.
    assert "SortMergeJoin" in plan(rows.join(offered(few.withColumn("a", F.array_repeat("gcf", 10_000)), few, 10_000), "id"))
    assert offered(few, few).join(rows, "id").count() == few.join(rows, "id").count()


def test_a_measured_side_is_not_broadcast_after_an_explode(spark):
    """Spark takes the rows of before the explode; the side was found to be larger than its part of the limit."""
    side = spark.range(10).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(1000))))
    spark.conf.set("settle.broadcastBytes", "8000")
    try:
        text = plan(spark.range(100).join(bounded(side), "id"))
    finally:
        spark.conf.unset("settle.broadcastBytes")
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_profile_shares_and_their_factors_are_not_sent_by_the_size_of_their_files(spark):
    t = Inputs(spark, FOLDER)
    assert "Broadcast" not in plan(d277.day_shares(t.tlm_rows, t.raw_gcf, t.raw_pc))


def test_shuffled_profile_shares_meet_the_rows_where_they_lie(spark):
    """Rows grown by the shares of a day are wide; neither they nor the half hours are moved."""
    t = Inputs(spark, FOLDER)
    want = sorted(map(repr, inputs.d277_all(t).selectExpr("date", "gsp_area", "settlement_period", "settlement_run", "round(meters_count, 3)").collect()))
    spark.conf.set("settle.broadcastBytes", "8")
    try:
        rows = inputs.d277_half_hours(t)
        text = plan(d277.profile_totals(rows))
        got = sorted(map(repr, inputs.d277_all(t).selectExpr("date", "gsp_area", "settlement_period", "settlement_run", "round(meters_count, 3)").collect()))
    finally:
        spark.conf.unset("settle.broadcastBytes")
    joined = text.index("SortMergeJoin [date")
    assert "Exchange" not in text[:joined] and "profile_class" in text[joined:].splitlines()[0]
    assert got == want

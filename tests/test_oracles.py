"""Every registered query gives the rows of its oracle."""

import pytest

from settle.checks.all_queries import ORACLES, QUERIES
from settle.checks.compare import connect, oracle_rows, spark_rows
from settle.checks.registry import Inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    columns, got = spark_rows(spark, FOLDER, name)
    expected, want = oracle_rows(con, name)
    assert columns == expected
    assert len(got) > 0
    assert got == want


def test_views_as_plans_hold_the_stored_rows(spark):
    stored, plans = Inputs(spark, FOLDER), Inputs(spark, FOLDER, landed=False)
    for view in ("raw_d276", "raw_pc", "raw_names_xml"):
        assert rows_of(getattr(stored, view)) == rows_of(getattr(plans, view))


def test_changed_tables_are_landed_anew(spark, tmp_path):
    for count in (40, 60):
        for name in ("lineitem", "orders", "supplier", "nation"):
            rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
            rows.limit(count).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        assert Inputs(spark, str(tmp_path)).raw_s014.count() >= count


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))

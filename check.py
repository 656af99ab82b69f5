"""Run registered queries next to their oracles: check.py [folder] [name ...]."""

import sys
import time

from pyspark.sql import SparkSession

from settle.checks.all_queries import QUERIES
from settle.checks.compare import connect, oracle_rows, spark_rows


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def show_difference(got, want):
    for label, part in (("missing", set(want) - set(got)), ("extra", set(got) - set(want))):
        for row in sorted(part)[:3]:
            print("   ", label, row)


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = session(), connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            columns, got = spark_rows(spark, folder, name)
            spent = time.time() - start
            expected, want = oracle_rows(con, name)
        except Exception as error:  # report and go on
            bad += 1
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
            continue
        same = got == want and columns == expected
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} {len(got)}/{len(want)} rows {spent:.1f} s", flush=True)
        if not same:
            print("    columns", columns, expected)
            show_difference(got, want)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

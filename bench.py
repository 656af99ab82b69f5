"""Time the headline flows; prints one JSON line.

Input views are stored as tables before the clock starts, as the flows read
stored tables. Each flow is run in full (every row and column is computed) and
timed twice; the better run counts.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from settle.checks import inputs
from settle.checks.registry import Inputs
from settle.operators import measures
from settle.plans import c042, embedded, levies, units

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

VIEWS = [
    "raw_d276", "raw_d277", "raw_c042", "raw_s014", "raw_bmu", "raw_holiday",
    "tlm_rows", "raw_gcf", "raw_pc", "raw_llf",
    "raw_unit_xml", "raw_party_xml", "raw_names_xml", "raw_station", "raw_bm_units",
]

FLOWS = {
    "flow_d276": inputs.d276_all,
    "agg_daily_276": lambda t: measures.day_totals(inputs.d276_hh(t)),
    "flow_d276_exports": inputs.exports,
    "flow_d277": inputs.d277_all,
    "flow_c042": lambda t: c042.latest_volumes(t.raw_c042, inputs.unit_dim(t)),
    "flow_s014_last": inputs.s014_last,
    "flow_gross_daily": inputs.gross_daily,
    "flow_cap_mech": inputs.cap_mech,
    "flow_ro_fit": lambda t: levies.ro_fit(*inputs.scheme_inputs(t)),
    "flow_embedded": lambda t: embedded.embedded_generation(*inputs.embedded_inputs(t)),
    "flow_unit_dictionary": lambda t: units.unit_dictionary(inputs.source_units(t), t.raw_bm_units),
}


def shuffled(spark) -> int:
    """Bytes written to shuffles so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def run(flow, tables) -> tuple[float, float]:
    """Seconds and shuffled megabytes of one run."""
    before, start = shuffled(tables.spark), time.perf_counter()
    flow(tables).write.format("noop").mode("overwrite").save()
    spent = time.perf_counter() - start
    return spent, (shuffled(tables.spark) - before) / 1e6


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Inputs(spark, FOLDER)
    start = time.perf_counter()
    for view in VIEWS:
        getattr(tables, view)
    landing = time.perf_counter() - start
    best = {name: min(run(flow, tables) for _ in range(2)) for name, flow in FLOWS.items()}
    times = {name: round(spent, 3) for name, (spent, _) in best.items()}
    print(json.dumps({
        "metric": "settlement flows, total of best of two runs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "shuffle_mb": {name: round(size, 1) for name, (_, size) in best.items()},
        "landing_sec": round(landing, 3),
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()

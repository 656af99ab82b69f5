"""Register of queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from settle.checks.views import VIEWS
from settle.session import configure, fresh_path

TABLES = ["lineitem", "orders", "supplier", "nation"]

# Views whose rows are those of the readings, one for one.
REPORTS = {name for name, sql in VIEWS.items() if sql.endswith("FROM readings")}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Named SQL steps that oracles share; `steps.py` adds the expected results.
STEPS: dict[str, str] = dict(VIEWS)

# Sums differ in the last bits with the order of rows. Numbers are compared to
# six places, moved a little first so that exact halves round alike in both.
NUDGE = 1.23456789e-9

# Bytes of a block of a saved view: what a task reads later.
BLOCK_BYTES = 8 << 20

# Rows of a table up to which reports over its few blocks are spread by a shuffle.
SPREAD_ROWS = 1 << 20

# Saved views by session, folder, rows of its tables and view: path and schema.
_LANDED: dict[tuple, tuple[str, StructType]] = {}


class Inputs:
    """The views over one folder of tables.

    Flows start from stored report and factor tables, so each view is saved once
    as a parquet table in the work folder; a given table may be a single file
    block, and its rows are spread evenly there. Reports over a table of many
    blocks or rows stay as they are dealt: spreading them would sort and move
    every row. They too are stored in small blocks, which later tasks share.
    Without `landed` the views are plans over the given tables.
    """

    def __init__(self, spark: SparkSession, folder: str, landed: bool = True):
        self.spark = configure(spark)
        self.folder = folder
        self.landed = landed
        # A view is saved anew when a file of the tables is another one.
        files = tuple(self._files(name) for name in TABLES) if landed else ()
        self._state = (spark.sparkContext.applicationId, folder, files)

    def _files(self, name: str) -> tuple:
        """Names, sizes and times of a table's files."""
        found = self.table(name).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        return tuple(sorted(map(tuple, found.distinct().collect())))

    def table(self, name: str) -> DataFrame:
        """One of the given tables."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        if not self.landed:
            return self._plan(name)
        key = (*self._state, name)
        if key not in _LANDED:
            made, path = self._plan(name), fresh_path(self.spark, name)
            self._spread(name, made).write.option("parquet.block.size", BLOCK_BYTES).parquet(path)
            _LANDED[key] = path, made.schema
        path, schema = _LANDED[key]
        return self.spark.read.schema(schema).parquet(path)

    def _spread(self, name: str, made: DataFrame) -> DataFrame:
        """Rows dealt evenly to all cores; not those of reports that many blocks deal so, or that are too many."""
        cores = self.spark.sparkContext.defaultParallelism
        if name in REPORTS:
            blocks, rows = self._blocks("lineitem")
            if 2 * blocks >= cores or rows > SPREAD_ROWS:
                return made
        return made.repartition(cores)

    def _blocks(self, name: str) -> tuple[int, int]:
        """Parts of a table's files that hold rows, of which a task of a scan reads one or more; all rows."""
        parts = self.table(name).select("_metadata.file_path", "_metadata.file_block_start")
        sizes = parts.groupBy(*parts.columns).agg(F.count("*").alias("n"))
        return tuple(sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())

    def _plan(self, name: str) -> DataFrame:
        for table in TABLES:
            self.table(table).createOrReplaceTempView(table)
        return self.spark.sql(with_steps(f"SELECT * FROM {name}"))


def with_steps(select: str, once: bool = False) -> str:
    """SQL preceded by the steps it names, directly or through others.

    `once` has DuckDB compute each step a single time, however often it is named.
    """
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b[a-z_0-9]+\b", sql):
            if name in STEPS and name not in needed:
                visit(STEPS[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    how = "AS MATERIALIZED" if once else "AS"
    ctes = ",\n".join(f"{n} {how} ({STEPS[n].strip()})" for n in needed)
    return f"WITH {ctes}\n{select.strip()}"


def _columns(spec: str) -> list[tuple[str, str]]:
    """Output columns as (name, kind): f number, d date, t time, else as it is."""
    return [tuple((word + ":").split(":")[:2]) for word in spec.split()]


def _present(df: DataFrame, spec: str) -> DataFrame:
    made = []
    for name, kind in _columns(spec):
        col = F.col(f"`{name}`")
        if kind == "f":
            col = F.round(col.cast("double") + NUDGE, 6) + 0.0
        elif kind == "d":
            col = col.cast("date").cast("string")
        elif kind == "t":
            col = F.date_format(col, "yyyy-MM-dd HH:mm")
        made.append(col.alias(name))
    return df.select(*made)


def _present_sql(select: str, spec: str) -> str:
    made = []
    for name, kind in _columns(spec):
        col = f'"{name}"'
        if kind == "f":
            col = f"round(CAST({col} AS DOUBLE) + {NUDGE}, 6) + 0e0"
        elif kind == "d":
            col = f"strftime(CAST({col} AS DATE), '%Y-%m-%d')"
        elif kind == "t":
            col = f"strftime({col}, '%Y-%m-%d %H:%M')"
        made.append(f'{col} AS "{name}"')
    return f"SELECT {', '.join(made)} FROM ({select.strip()}) AS result"


def query(name: str, spec: str, sql: str):
    """Register a query under `name`, its output columns and its oracle."""

    def register(function: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _present(function(Inputs(spark, folder)), spec)

        QUERIES[name] = run
        ORACLES[name] = with_steps(_present_sql(sql, spec), once=True)
        return function

    return register

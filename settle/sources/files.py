"""Loaders of reference data landed as files.

Columns are found by their names in each file's own header, so files may add
columns or order them otherwise. A file that lacks a column, or a date in no
known form, fails the load.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from settle import schemas
from settle.functions.flags import lookup
from settle.functions.text import any_date, plain_name
from settle.session import bounded, stage
from settle.sources.codes import BM_UNIT_COLUMNS, ZONE_AREA

LLF_COLUMNS = [
    "market_participant_id", "llf_class_id", "start_settlement_date",
    "end_settlement_date", "day_type", "value",
    "start_settlement_period", "end_settlement_period",
]

# Lines above the header in the published list of units.
PREAMBLE = 2


def header_names(line: str, wanted: list[str], where: str) -> list[str]:
    """Plain names of a header line; all wanted ones must be among them, each once."""
    def key(name: str) -> str:
        return plain_name(name).strip("_")

    names = [key(name) for name in next(csv.reader([line.lstrip("\ufeff").rstrip("\r")]))]
    known = {key(name): name for name in wanted}
    missing = [name for plain, name in known.items() if names.count(plain) != 1]
    if missing:
        raise ValueError(f"{where}: header must have once each of {missing}")
    # Other columns are not used; distinct names keep them apart.
    return [known.get(name, f"_other_{i}") for i, name in enumerate(names)]


def file_headers(landed: DataFrame) -> DataFrame:
    """First line that is not blank of each file: file, header.

    Computed once and kept in the work folder, a row for each file.
    """
    lines = landed.where("_metadata.file_block_start = 0").where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), F.struct(F.monotonically_increasing_id().alias("line"), "value").alias("top")
    )
    return stage(lines.groupBy("file").agg(F.min("top")["value"].alias("header")), "headers")


def routed(landed: DataFrame, headers: DataFrame, layouts: dict[str, list[str]], wanted: list[str]) -> DataFrame:
    """Fields of files with several layouts, from one scan: each line by the layout of its file."""
    width = max(map(len, layouts.values()))
    numbered = F.create_map(*[F.lit(v) for pair in enumerate(layouts) for v in reversed(pair)])
    side = bounded(headers.select("file", "header", numbered[F.col("header")].alias("layout")), within=headers)
    lines = landed.where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file")).join(side, "file")
    fields = F.from_csv("value", ", ".join(f"_{i} string" for i in range(width)))
    parsed = lines.where(F.col("value") != F.col("header")).select("layout", fields.alias("field"))

    def of_layout(name: str) -> Column:
        places = [F.when(F.col("layout") == i, F.col(f"field._{names.index(name)}")) for i, names in enumerate(layouts.values())]
        return F.coalesce(*places).alias(name)

    return parsed.select(*[of_layout(name) for name in wanted])


def scan_csv_many(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The columns of a schema from all CSV files below a folder, with plain lower-case names.

    The layout of a file is its own first line. The first lines come from a pass
    over the text; only the distinct ones reach the driver, never a list of
    files. Then the data are one scan, whatever the layouts are: with one layout
    Spark's CSV reader, with several the lines are joined to the layout of their
    file. Text that is not a number becomes null; a line equal to its file's
    header is no data.
    """
    def read():
        return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")

    fields = StructType.fromDDL(schema).fields
    wanted = [plain_name(field.name) for field in fields]
    landed = read().text(folder)
    headers = file_headers(landed)
    firsts = headers.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
    layouts = {row["header"]: header_names(row["header"], wanted, row["file"]) for row in firsts}
    if not layouts:
        raise ValueError(f"{folder}: no CSV file with a header")
    if len(layouts) == 1:
        names = next(iter(layouts.values()))
        text = ", ".join(f"`{name}` string" for name in names)
        rows = read().schema(text).option("header", True).csv(folder)
    else:
        rows = routed(landed, headers, layouts, wanted)
    return rows.select(*[
        F.col(name).try_cast(field.dataType).alias(name) for name, field in zip(wanted, fields, strict=True)
    ])


def load_tlm(spark: SparkSession, folder: str) -> DataFrame:
    """Loss multipliers; zone number to area, and a delivering factor of 0 means 1."""
    df = scan_csv_many(spark, folder, schemas.TLM_FILE)
    delivering = F.when(F.col("delivering") == 0, 1.0).otherwise(F.col("delivering"))
    return df.select(
        any_date("settlement_date").alias("settlement_date"),
        "settlement_run_type", "settlement_period", "off_taking",
        delivering.alias("delivering"),
        lookup(ZONE_AREA, F.col("zone")).alias("gsp_area"),
    )


def load_gcf(spark: SparkSession, folder: str) -> DataFrame:
    """Grid correction factors."""
    df = scan_csv_many(spark, folder, schemas.GCF_FILE)
    return df.select(
        F.col("gsp_group_id").alias("gsp_area"),
        any_date("settlement_date").alias("settlement_date"),
        F.col("ssr_run_type").alias("run_type"),
        F.col("settlement_period").cast("int").alias("settlement_period"),
        F.col("gsp_group_correction_factor").alias("gcf"),
    )


def load_llf(spark: SparkSession, folder: str) -> DataFrame:
    """Line-loss factors: complete rows, each once."""
    df = scan_csv_many(spark, folder, schemas.LLF_FILE)
    dates = {c: any_date(c) for c in ("start_settlement_date", "end_settlement_date")}
    return df.withColumns(dates).select(*LLF_COLUMNS).na.drop().dropDuplicates()


def load_pc(spark: SparkSession, folder: str) -> DataFrame:
    """Profile coefficients, wide: one column for each period."""
    df = scan_csv_many(spark, folder, schemas.PC_FILE)
    return df.withColumn("settlement_date", any_date("settlement_date"))


def load_bm_units(spark: SparkSession, folder: str) -> DataFrame:
    """Registered units: 28 text columns below two lines of preamble and a header.

    The list is published as one small file, so each file is read whole and its
    lines are counted.
    """
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    lines = files.select(F.split("value", r"\r?\n").alias("lines")).where(F.size("lines") > PREAMBLE)
    split = lines.select(
        F.col("lines")[PREAMBLE].alias("header"), F.explode(F.slice("lines", PREAMBLE + 2, 2**31 - 1)).alias("line")
    ).where(F.trim("line") != "")
    parts = []
    for row in lines.select(F.col("lines")[PREAMBLE].alias("header")).distinct().collect():
        names = header_names(row.header, BM_UNIT_COLUMNS, folder)
        text = ", ".join(f"`{name}` string" for name in names)
        fields = F.from_csv("line", text).alias("unit")
        parts.append(split.where(F.col("header") == row.header).select(fields).select(*[f"unit.`{c}`" for c in BM_UNIT_COLUMNS]))
    if not parts:
        raise ValueError(f"{folder}: no list of units")
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    return made.where(F.col("bm_unit_id").isNotNull())

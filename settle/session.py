"""Session settings, the shared work folder and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

# What all sides that a flow sends whole to every executor may have together. A
# flow has SIDES of them at most, and each may have its part. A session may set
# `settle.broadcastBytes` to another total.
BROADCAST_BYTES = 256 << 20
SIDES = 8

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even if the rows have to move once more afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # `d277.half_hours` turns it off where its shares are shuffled.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Stored reports are packed tightly and grow many times when parsed, so tasks read
    # little, and shuffles begin with many parts, put together up to the advisory size.
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors share.

    The cluster names it in `spark.checkpoint.dir`. Where that is unset a
    temporary folder serves, but only for a local master: executors of a
    cluster would each write to a disk of their own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = _local_folder(context.master)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def _local_folder(master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    folder = tempfile.mkdtemp(prefix="settle-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Used where several later steps read the same result, so that an expensive
    flow runs once and lost executors do not cause it to run again.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(df: DataFrame) -> DataFrame:
    """Compute a small result once into the checkpoint folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


# A stored table is compressed: what its files hold is taken to be so many times larger in memory.
EXPANSION = 4


def size_of(df: DataFrame) -> int:
    """Bytes of all rows, written out as text."""
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def file_bytes(df: DataFrame) -> int | None:
    """Bytes of a stored table by its files, without a job; None if the rows come from more than one scan."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    if leaves.size() != 1 or leaves.head().nodeName() != "LogicalRelation":
        return None
    node = plan
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    if node.nodeName() != "LogicalRelation":
        return None
    return int(str(node.stats().sizeInBytes())) * EXPANSION


def _limit(spark: SparkSession) -> int:
    return int(spark.conf.get("settle.broadcastBytes", str(BROADCAST_BYTES))) // SIDES


def _width(kind: DataType, places: int) -> int:
    """Bytes of a value in a row in memory, without those of its text; an array has so many places."""
    if isinstance(kind, StructType):
        return 16 + sum(_width(field.dataType, places) for field in kind)
    if isinstance(kind, ArrayType):
        return 24 + places * _width(kind.elementType, places)
    return 8


def offered(df: DataFrame, within: DataFrame, places: int = 1) -> DataFrame:
    """Offer a join side for broadcast if it `fits`; a larger one is shuffled."""
    return F.broadcast(df) if fits(df, within, places) else df.hint("merge")


def fits(df: DataFrame, within: DataFrame, places: int = 1) -> bool:
    """Whether the rows of a join side take no more memory than its part of the limit.

    For sides that have at most the rows and texts of a stored table, whose files
    may be a hundred times smaller than its rows: few values that repeat take next to
    nothing there. Spark goes by the files and would broadcast such a side on its own.
    Rows are counted only of files that are small themselves.
    """
    limit, stored = _limit(df.sparkSession), file_bytes(within)
    if stored is not None and stored > limit:
        return False
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in within.schema if isinstance(f.dataType, StringType)]
    rows, text = within.agg(F.count("*"), F.sum(sum(texts, F.lit(0).cast("bigint")))).first()
    return rows * _width(df.schema, places) + (text or 0) <= limit


def bounded(df: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """Offer a join side for broadcast if its measured size is small.

    The side is computed once into the checkpoint folder and measured there. If
    it cannot outgrow a stored table, that table is passed as `within` and the
    side stays a plan: the table's files are measured, without a job, or its rows
    where it is no plain scan. A larger side is returned
    without a hint: the join then shuffles both sides and adaptive execution
    splits hot keys. A side that was measured itself says so by a hint, as Spark may
    still take it for small (after an explode it counts the rows of before).
    """
    limit = _limit(df.sparkSession)
    if within is None:
        side = once(df)
        size = size_of(side)
        if size > limit:
            return side.hint("merge")
    else:
        side, stored = df, file_bytes(within)
        size = size_of(within) if stored is None else stored
    return F.broadcast(side) if size <= limit else side

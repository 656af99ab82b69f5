"""Reference factors made unique, and their joins to half-hourly rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.functions.flags import run_rank
from settle.functions.text import integer
from settle.operators.ranges import limit_columns
from settle.schemas import PERIOD_COLUMNS
from settle.session import bounded

PERIODS = len(PERIOD_COLUMNS)


def unique_factor(df: DataFrame, run: str, *values: str) -> DataFrame:
    """One row by date, period and area: the latest run wins.

    Ties of the same run take the larger value, so that the answer does not
    depend on row order.
    """
    order = F.struct(F.coalesce(run_rank(run), F.lit(0)), *values)
    latest = df.groupBy("settlement_date", "settlement_period", "gsp_area").agg(
        F.max(order).alias("_latest")
    )
    picked = {v: F.col(f"_latest.{v}") for v in values}
    return latest.withColumns(picked).drop("_latest")


def loss_multipliers(tlm: DataFrame) -> DataFrame:
    return unique_factor(tlm, "settlement_run_type", "off_taking")


def grid_factors(gcf: DataFrame) -> DataFrame:
    return unique_factor(gcf, "run_type", "gcf")


def join_factor(df: DataFrame, factor: DataFrame, how="left", date="date") -> DataFrame:
    """Add a factor by date, area and period."""
    side = factor.withColumnRenamed("settlement_date", date)
    return df.join(side, [date, "gsp_area", "settlement_period"], how)


def by_period(value: str) -> Column:
    """Values of a day as an array with one place for each period."""
    places = [f"max(if(settlement_period = {p}, {value}, null))" for p in range(1, PERIODS + 1)]
    return F.expr(f"array({', '.join(places)})")


def day_factors(tlm: DataFrame, gcf: DataFrame) -> DataFrame:
    """Loss multiplier times grid correction, an array by date and area."""
    # Both lie by these keys already. Their files are far smaller than their rows, so
    # Spark is not left to choose one for broadcast; the same holds of `day_shares`.
    both = loss_multipliers(tlm).join(
        grid_factors(gcf).hint("merge"), ["settlement_date", "gsp_area", "settlement_period"]
    )
    return (
        both.withColumn("factor", F.col("gcf") * F.col("off_taking"))
        .groupBy(F.col("settlement_date").alias("date"), "gsp_area")
        .agg(by_period("factor").alias("factors"))
    )


def day_profiles(pc: DataFrame) -> DataFrame:
    """Profile coefficients, an array by profile, area, configuration, regime and date."""
    return pc.select(
        integer("profile_class_id").alias("profile_class"),
        F.col("gsp_group_id").alias("gsp_area"),
        F.col("std_settlement_config_id").alias("configuration"),
        integer("time_pattern_regime_id").alias("regime"),
        F.col("settlement_date").alias("date"),
        F.array(*PERIOD_COLUMNS).alias("shares"),
    )


def period_shares(df: DataFrame) -> DataFrame:
    """Shares and factors of a day as one array of (pc, factor), one place a period."""
    pairs = F.arrays_zip(F.col("shares").alias("pc"), F.col("factors").alias("factor"))
    return df.withColumn("periods", pairs).drop("shares", "factors")


def unpivot_profiles(pc: DataFrame) -> DataFrame:
    """One row for each period of a wide coefficient row, nulls included."""
    ids = [c for c in pc.columns if c.lower() not in PERIOD_COLUMNS]
    places = F.posexplode(F.array(*PERIOD_COLUMNS)).alias("place", "pc")
    return pc.select(*ids, places).select(
        *ids, (F.col("place") + 1).alias("settlement_period"), "pc"
    )


def loss_bands(llf: DataFrame, limits: DataFrame) -> DataFrame:
    """Line-loss validity rows, one for each month they touch inside `limits`.

    The month makes an equality key of a date range, so the range join neither
    tests every range of a class nor lands on a few class keys.
    """
    first, last = limit_columns(limits)
    low = F.greatest(F.col("start_settlement_date"), first)
    high = F.least(F.col("end_settlement_date"), last)
    months = F.sequence(F.trunc(low, "MM"), F.trunc(high, "MM"), F.expr("interval 1 month"))
    return (
        llf.where(low <= high)
        .withColumn("month", F.explode(months))
        .select(
            F.col("market_participant_id").alias("distributor"),
            F.col("llf_class_id").alias("loss_class"),
            "day_type", "month", "start_settlement_date", "end_settlement_date",
            F.col("start_settlement_period").cast("int").alias("first_period"),
            F.col("end_settlement_period").cast("int").alias("last_period"),
            F.col("value").alias("llf"),
        )
    )


def bands_in_use(bands: DataFrame, used: DataFrame) -> DataFrame:
    """Loss bands of the classes and months in use; no others find a row to join."""
    return bands.join(bounded(used), ["distributor", "loss_class", "month"], "left_semi")


def join_loss_bands(df: DataFrame, bands: DataFrame) -> DataFrame:
    """Loss bands valid on a row's date and day type; one row for each band."""
    valid = F.col("date").between(F.col("start_settlement_date"), F.col("end_settlement_date"))
    return (
        df.withColumn("month", F.trunc("date", "MM"))
        .join(bands, ["distributor", "loss_class", "day_type", "month"])
        .where(valid)
        .drop("month", "start_settlement_date", "end_settlement_date")
    )


def expand_periods(df: DataFrame) -> DataFrame:
    """Half-hourly rows of the periods of a band that have share and factor.

    The band cuts its part out of the day before the day is spread, so that
    half-hourly rows carry two numbers and not the arrays.
    """
    first = F.greatest(F.col("first_period"), F.lit(1))
    last = F.least(F.col("last_period"), F.lit(PERIODS))
    part = F.slice("periods", first, F.greatest(last - first + 1, F.lit(0)))
    spread = df.select(
        *[c for c in df.columns if c != "periods"],
        F.posexplode(part).alias("_place", "_period"),
    )
    return (
        spread.where(F.col("_period.pc").isNotNull() & F.col("_period.factor").isNotNull())
        .withColumns({
            "settlement_period": F.col("_place") + first,
            "pc": F.col("_period.pc"),
            "factor": F.col("_period.factor"),
        })
        .drop("_place", "_period", "first_period", "last_period")
    )


def cross_periods(df: DataFrame) -> DataFrame:
    """Each row once for each of the 50 possible periods."""
    return df.withColumn("settlement_period", F.explode(F.sequence(F.lit(1), F.lit(PERIODS))))

"""Calendar expressions: day type, financial year, year to date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.session import once

# Days by which a date is moved so that 1 April falls on day 1 of a year.
FINANCIAL_SHIFT = 90

WINTER_MONTHS = [11, 12, 1, 2]


def is_weekday(date: str) -> Column:
    return F.dayofweek(date).between(2, 6)


def add_day_type(
    df: DataFrame, holidays: DataFrame, date: str, out: str,
    working: str = "WD", other: str = "NWD",
) -> DataFrame:
    """Working day: Monday to Friday and not a holiday.

    `holidays` has one row a date (`sources.holidays.working_calendar`).
    """
    days = holidays.select(F.col("holiday_date").alias("_holiday"))
    works = is_weekday(date) & F.col("_holiday").isNull()
    return (
        df.join(days, F.col(date) == F.col("_holiday"), "left")
        .withColumn(out, F.when(works, working).otherwise(other))
        .drop("_holiday")
    )


def fin_year(date: str) -> Column:
    """April-start year such as 2019-20; the second part is not padded."""
    year = F.year(date)
    start = F.when(F.month(date) >= 4, year).otherwise(year - 1)
    return F.concat(start.cast("string"), F.lit("-"), ((start + 1) % 100).cast("string"))


def month_start(date: str) -> Column:
    return F.trunc(date, "MM")


def cap_mech(date: str, day_type: str) -> Column:
    """1 on winter working days, else 0."""
    test = F.month(date).isin(WINTER_MONTHS) & (F.col(day_type) == "wd")
    return F.when(test, 1).otherwise(0)


def add_to_date_flags(df: DataFrame, date: str = "date", dates: DataFrame | None = None) -> DataFrame:
    """`ytd` and `fytd`: not later in the (financial) year than the latest date.

    `dates` may give the same dates from a cheaper plan than that of `df`.
    """
    source = df if dates is None else dates
    latest = once(source.agg(F.max(date).alias("latest"))).scalar()
    moved = F.date_sub(F.col(date), FINANCIAL_SHIFT)
    last_moved = F.date_sub(latest, FINANCIAL_SHIFT)
    return df.withColumns({
        "ytd": F.when(F.dayofyear(date) <= F.dayofyear(latest), 1).otherwise(0),
        "fytd": F.when(F.dayofyear(moved) <= F.dayofyear(last_moved), 1).otherwise(0),
    })


def period_start(date: str, period: str) -> Column:
    """Local start of a settlement period; clock changes are ignored."""
    start = F.col(date).cast("timestamp_ntz")
    minutes = (F.col(period) - 1) * 30
    return F.timestamp_add("MINUTE", minutes.cast("int"), start)

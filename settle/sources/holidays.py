"""Holiday dates that count in settlement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def working_calendar(holidays: DataFrame) -> DataFrame:
    """Non-working dates from a holiday list (`holiday_date`, `label`).

    Holidays of Scotland or Northern Ireland only are left out; a label that
    names England, or a New Year's Day entry with an addition, stays. A date
    comes out once, so a join cannot multiply rows.
    """
    label = F.col("label")
    regional = label.contains("Scotland") | label.contains("Northern Ireland")
    kept = ~regional | label.contains("England") | label.contains("New Year's Day ")
    return (
        holidays.where(kept & F.col("holiday_date").isNotNull())
        .select("holiday_date")
        .dropDuplicates()
        .withColumn("wd", F.lit("NWD"))
    )

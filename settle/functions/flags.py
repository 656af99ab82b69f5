"""Row flags as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from settle.sources.codes import FIT_MONTH_LIMIT, RO_MONTH_LIMIT, RUN_RANK, SCHEME_RUN_RANK


def lookup(mapping: dict, key: Column) -> Column:
    """Value of a small fixed mapping, null where the key is unknown."""
    items = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*items), key)


def run_rank(run: str) -> Column:
    return lookup(RUN_RANK, F.col(run))


def scheme_rank(run: str) -> Column:
    return lookup(SCHEME_RUN_RANK, F.col(run))


def peak(period: str) -> Column:
    """'P' in settlement periods 33 to 38 (16:00-19:00), else 'N'."""
    return F.when(F.col(period).between(33, 38), "P").otherwise("N")


def import_export(volume: str) -> Column:
    """Sign of a metered volume; no reading counts as import."""
    return F.when(F.col(volume) >= 0, "export").otherwise("import")


def actual_estimate(estimated: str) -> Column:
    """'A' for a false estimate indicator; true or unknown is 'E'."""
    return F.when(~F.col(estimated), "A").otherwise("E")


def in_ranges(col: str, ranges: list[tuple[int, int]]) -> Column:
    test = F.lit(False)
    for low, high in ranges:
        test = test | F.col(col).between(low, high)
    return test


def _within_limit(date: str, rank: Column, limits: dict[int, int]) -> Column:
    limit = lookup(limits, F.month(date))
    return F.coalesce(rank <= limit, F.lit(False))


def ro_eligible(date: str, rank: Column) -> Column:
    """May this run still feed the renewables obligation in its month?"""
    return _within_limit(date, rank, RO_MONTH_LIMIT)


def fit_eligible(date: str, rank: Column) -> Column:
    """May this run still feed the feed-in tariff in its month?"""
    return _within_limit(date, rank, FIT_MONTH_LIMIT)


def missing_volume(whole: Column, known: Column) -> Column:
    """Part of a total that is not explained; never negative, 0 if unknown."""
    return F.greatest(whole - known, F.lit(0.0))


def row_mean(*cols: str) -> Column:
    """Mean over columns of a row, nulls left out; null if all are null."""
    values = F.filter(F.array(*cols), lambda x: x.isNotNull())
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def all_present(*cols: str) -> Column:
    test = F.lit(True)
    for name in cols:
        test = test & F.col(name).isNotNull()
    return test

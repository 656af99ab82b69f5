"""Report rows whose date or period cannot be read: listed, counted against a bound, set aside.

Without this step a report with such a row fails when it is parsed. With it the
rows are saved with the names of their unreadable fields, and the others go on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.functions.text import present

# Field -> the expression that reads it, null where it cannot.
Fields = dict[str, Callable[[str], Column]]


def unreadable(fields: Fields) -> Column:
    """Names of the fields that hold text from which no value can be read."""
    names = [F.when(read(name).isNull() & present(name), F.lit(name)) for name, read in fields.items()]
    return F.array_compact(F.array(*names))


def admitted(raw: DataFrame, fields: Fields) -> DataFrame:
    """The rows whose fields can be read or are empty."""
    return raw.where(F.size(unreadable(fields)) == 0)


def rejected(raw: DataFrame, fields: Fields) -> DataFrame:
    """The other rows, with the names of the fields in `unreadable`."""
    return raw.withColumn("unreadable", unreadable(fields)).where(F.size("unreadable") > 0)


def bound(rejects: DataFrame, fields: Fields, most: int, name: str) -> None:
    """Fail where more rows are rejected than allowed; reads a saved table of rejects."""
    count = rejects.count()
    if count > most:
        example = rejects.select("unreadable", F.to_json(F.struct(*fields)).alias("fields")).first()
        raise ValueError(
            f"{name}: {count} rows cannot be read, {most} are allowed; for example {example['fields']}: {example['unreadable']}"
        )

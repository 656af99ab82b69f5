"""Text parsing and naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number(col: str | Column) -> Column:
    """Text to double; text that is not a number becomes null."""
    return F.col(col).try_cast("double") if isinstance(col, str) else col.try_cast("double")


def integer(col: str) -> Column:
    """Text to int, also from '7.0'."""
    return number(col).try_cast("int")


# Forms in which dates arrive, in the order in which they are tried after ISO.
DATE_FORMS = ["dd/MM/yyyy", "d/M/yyyy", "yyyyMMdd", "dd-MM-yyyy", "yyyy/MM/dd"]


def try_date(col: str | Column) -> Column:
    """Date from text in any known form; null for any other text."""
    text = F.trim((F.col(col) if isinstance(col, str) else col).cast("string"))
    return F.coalesce(text.try_cast("date"), *[F.try_to_date(text, form) for form in DATE_FORMS])


def try_compact_date(col: str) -> Column:
    """Date from text that begins with yyyyMMdd, or in any other known form; null for any other text.

    The usual form is put as yyyy-MM-dd and cast, which is twice as fast as a
    format pattern; the others are tried only where that gives nothing.
    """
    parts = [F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2)]
    usual = F.concat_ws("-", *parts).try_cast("date")
    return F.coalesce(usual, F.when(usual.isNull(), try_date(col)))


def present(col: str | Column) -> Column:
    """Text that is neither null nor blank."""
    return F.trim((F.col(col) if isinstance(col, str) else col).cast("string")) != ""


def strict(col: str | Column, value: Column, kind: str, what: str) -> Column:
    """The value, or failure of the job where there is text but no value.

    A field that silently became null would take its row along further on.
    """
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    wrong = F.raise_error(F.concat(F.lit(f"{what}: "), text)).cast(kind)
    return F.when(value.isNull() & present(col), wrong).otherwise(value)


def compact_date(col: str) -> Column:
    """Date as of `try_compact_date`; other text fails the job."""
    return strict(col, try_compact_date(col), "date", "no known form of date")


def made_once(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns computed before any condition on them.

    Conditions move below the parsing and would repeat it, several times a row
    for a date; they stop at a generated column. Conditions on others do not.
    """
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def any_date(col: str | Column) -> Column:
    """Date as of `try_date`; other text fails the job. Blank text is null."""
    return strict(col, try_date(col), "date", "no known form of date")


def date_of(df: DataFrame, col: str) -> Column:
    """A column of dates as it is, so that filters on it reach the scan; any other as of `any_date`."""
    return F.col(col) if df.select(col).dtypes[0][1] == "date" else any_date(col)


def period(col: str) -> Column:
    """Settlement period as a number; other text fails the job."""
    return strict(col, integer(col), "int", "no settlement period")


def player(unit: str) -> Column:
    """First two characters of a unit id."""
    return F.substring(unit, 1, 2)


def plain_name(name: str) -> str:
    """Column name in lower case with `_` for spaces and slashes, no brackets."""
    name = name.strip().lower().replace(" ", "_").replace("/", "_")
    return name.replace("[", "").replace("]", "")

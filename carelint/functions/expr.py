"""Column expressions shared by the checks.  All of them stay inside the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelint import model


def text(c: Column) -> Column:
    return c.cast("string")


def norm(c: Column) -> Column:
    """Upper-cased, space-trimmed text."""
    return F.upper(F.trim(text(c)))


def present(c: Column) -> Column:
    """Neither null nor blank."""
    return c.isNotNull() & (F.trim(text(c)) != "")


def known(c: Column) -> Column:
    """Present, and not one of the "unknown" flavours."""
    return present(c) & ~norm(c).isin(*model.UNKNOWN_VALUES)


def clean_code(c: Column) -> Column:
    """A code without dots, commas and white space, in upper case."""
    return F.upper(F.regexp_replace(text(c), r"[.,\s]", ""))


def is_string(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[_real_name(df, column)].dataType, (T.StringType, T.CharType, T.VarcharType))


def type_name(df: DataFrame, column: str) -> str:
    return df.schema[_real_name(df, column)].dataType.simpleString()


def _real_name(df: DataFrame, column: str) -> str:
    return next(n for n in df.columns if n.upper() == column.upper())


def date_of(df: DataFrame, column: str, formats: tuple[str, ...] = ()) -> Column:
    """The column as a date, null where it cannot be read.

    Date columns pass through untouched so that comparisons on them reach the scan.
    Text is read as ISO first, then with each extra format.
    """
    kind = df.schema[_real_name(df, column)].dataType
    c = F.col(column)
    if isinstance(kind, T.DateType):
        return c
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    iso = text(c).try_cast("date")
    return F.coalesce(iso, *[F.try_to_date(text(c), f) for f in formats]) if formats else iso


def text_years(c: Column, start: dt.date | None, end: dt.date | None) -> Column:
    """A comparison of ISO text that reaches the scan and holds for every date of the years asked for.

    Text that starts below "1" (a blank, a sign, a leading zero) always passes; the date decides.  Text
    of a year beyond 9999 may pass or not, so callers have to leave such years out.
    """
    test = F.lit(True)
    if start is not None and start.year > 1000:
        test = test & ((c >= F.lit(f"{start.year:04d}")) | (c < F.lit("1")))
    if end is not None and end.year < 9999:
        test = test & (c < F.lit(f"{max(end.year, 999) + 1:04d}"))
    return test


def is_dated(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[_real_name(df, column)].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))


def month(c: Column) -> Column:
    return F.trunc(c, "MM")


def ratio(n: Column, d: Column, scale: float = 1.0, empty: float | None = None) -> Column:
    """n / d * scale, with ``empty`` (default null) when d is zero or null."""
    value = n.cast("double") / d.cast("double")
    if scale != 1.0:
        value = value * F.lit(scale)
    return F.when(d > 0, value).otherwise(F.lit(empty).cast("double"))


def percent(n: Column, d: Column, empty: float | None = None) -> Column:
    return ratio(n, d, 100.0, empty)


def flag(test: Column) -> Column:
    """1 when the test holds, else 0 (also for null)."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0))


def n_where(test: Column) -> Column:
    return F.count_if(test)

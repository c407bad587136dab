"""What a check run looks at: sources, reference tables, restrictions and overrides."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelint import model
from carelint.functions import expr as E
from carelint.sources.tables import TableSource

_BLANK = {"", "NONE", "NULL", "(NONE)"}


def blank_to_none(value: Any) -> Any:
    """Blank-like parameters (empty, NONE, NULL, (NONE)) mean "not given"."""
    if isinstance(value, str):
        value = value.strip()
        return None if value.upper() in _BLANK else value
    return value


def to_date(value: Any) -> dt.date | None:
    value = blank_to_none(value)
    if value is None or (isinstance(value, dt.date) and not isinstance(value, dt.datetime)):
        return value
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(value)


def ten_year_lookback(today: dt.date) -> dt.date:
    """Start date of the ten-year window; 29 February falls back to the 28th."""
    try:
        return today.replace(year=today.year - 10)
    except ValueError:
        return today.replace(year=today.year - 10, day=28)


@dataclass(frozen=True)
class Context:
    source: TableSource
    refs: TableSource | None = None
    prev: TableSource | None = None
    target: str | None = None
    start: dt.date | None = None
    end: dt.date | None = None
    anchor: dt.date | None = None
    options: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        target = blank_to_none(self.target)
        target = target.upper() if target else None
        object.__setattr__(self, "target", None if target == "ALL" else target)
        for name in ("start", "end", "anchor"):
            object.__setattr__(self, name, to_date(getattr(self, name)))

    @property
    def spark(self) -> SparkSession:
        return self.source.spark

    @property
    def scope(self) -> str:
        """Label of the rows that describe the whole check."""
        return self.target or "ALL"

    @property
    def as_of(self) -> dt.date:
        return self.anchor or dt.date.today()

    def option(self, name: str, default: Any) -> Any:
        return self.options.get(name, default)

    def with_target(self, target: str | None) -> Context:
        return replace(self, target=target)

    def wants(self, table: str) -> bool:
        return self.target is None or self.target == table

    def require_target(self, allowed) -> None:
        if self.target is not None and self.target not in allowed:
            raise ValueError(f"target table {self.target!r} is not one of {sorted(allowed)}")

    def has(self, table: str, *columns: str) -> bool:
        return self.source.has(table, *columns)

    def missing(self, table: str, *columns: str) -> list[str]:
        return [c for c in columns if not self.source.has(table, c)]

    def ref(self, table: str, *columns: str) -> DataFrame | None:
        if self.refs is None or not self.refs.has(table, *columns):
            return None
        return self.refs.frame(table)

    def frame(self, table: str, *, windowed: bool = True, date_column: str | None = None) -> DataFrame:
        """The table, restricted to the date window on its (or the given) date column."""
        df = self.source.frame(table)
        column = date_column or model.DATE_COLUMN.get(table)
        if not windowed or column is None or (self.start is None and self.end is None):
            return df
        return df.filter(self.window(df, column))

    def window(self, df: DataFrame, column: str):
        """Inclusive window test; rows whose date cannot be read drop out.

        Text dates of other years are left out by a comparison of the text, which the scan can use; a
        year of more than four digits is in no window.
        """
        test = F.lit(True)
        if E.is_string(df, column):
            test = E.text_years(F.col(column), self.start, self.end) & (E.date_of(df, column) <= F.lit(dt.date.max))
        if self.start is not None:
            test = test & (E.date_of(df, column) >= F.lit(self.start))
        if self.end is not None:
            test = test & (E.date_of(df, column) <= F.lit(self.end))
        return test

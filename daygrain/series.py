"""What identifies one series and how its rows are ordered."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Series:
    """Key columns, time column and block length of a table holding one or many series.

    ``keys`` may be empty (the whole table is one series).  ``tie`` orders rows that share a
    time.  ``span`` is the length of a time block: days for dates and timestamps (a fraction of
    a day is allowed), plain units for a numeric time column.  A series is never put into one
    task as a whole, only one block of it, so ``span`` bounds the rows a task sorts.
    """

    keys: tuple[str, ...] = ()
    time: str = "date"
    tie: tuple[str, ...] = ()
    span: float = 1024

    def order(self) -> list[Column]:
        return [F.col(c) for c in (self.time, *self.tie)]

    def block(self, df: DataFrame) -> Column:
        """Block number of a row, a plain projection of the time column."""
        time = F.col(self.time)
        kind = df.schema[self.time].dataType
        if isinstance(kind, T.DateType):
            return F.floor(F.unix_date(time) / F.lit(float(self.span)))
        if isinstance(kind, T.TimestampType):
            return F.floor(F.unix_micros(time) / F.lit(self.span * 86400e6))
        if isinstance(kind, T.TimestampNTZType):
            clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
            return F.floor((F.unix_date(F.to_date(time)) + clock / F.lit(86400.0)) / F.lit(float(self.span)))
        return F.floor(time / F.lit(float(self.span)))

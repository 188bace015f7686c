"""Timestamp parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(col: str | Column) -> Column:
    """Timestamp of a value; NULL where the text is malformed, under ANSI mode as well."""
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col)


def month_start(col: str | Column) -> Column:
    """First instant of the month, as a timestamp without zone."""
    return F.date_trunc("month", col).cast("timestamp_ntz")


def is_weekend(day: str | Column) -> Column:
    return F.dayofweek(day).isin(1, 7)

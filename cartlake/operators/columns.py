"""Column names, stamps, timestamp casts and partition columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions.dates import parse_timestamp
from cartlake.functions.names import clean_names
from cartlake.specs import INGESTED_AT, UPDATED_AT


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def stamp_ingested(df: DataFrame) -> DataFrame:
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def stamp_updated(df: DataFrame) -> DataFrame:
    return df.withColumn(UPDATED_AT, F.current_timestamp())


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} has no column {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def empty_like(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))


def cast_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Parse ``column`` in place; malformed text becomes NULL."""
    require_columns(df, [column])
    return df.withColumn(column, parse_timestamp(column))


def split_bad_timestamps(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose timestamp parses (or is absent), and rows whose text does not parse."""
    require_columns(df, [column])
    bad = F.col(column).isNotNull() & parse_timestamp(column).isNull()
    return df.where(~bad), df.where(bad)


def with_partition_columns(df: DataFrame, column: str, parts: Sequence[str] = ("year", "month")) -> DataFrame:
    require_columns(df, [column])
    make = {"year": F.year, "month": F.month}
    return df.withColumns({p: make[p](F.col(column)) for p in parts})


def between_dates(
    df: DataFrame,
    first: dt.date,
    last: dt.date,
    column: str,
    parts: Sequence[str] = ("year", "month"),
) -> DataFrame:
    """Rows with ``first <= column < last + 1 day``.

    A timestamp predicate alone does not prune ``year``/``month`` folders, so the range is stated
    on the partition columns as well, two days wider at both ends: the folders may have been
    made under another time zone than the one of this session.
    """
    if first > last:
        raise ValueError(f"{first} is after {last}")
    lo, hi = F.lit(first).cast("date"), F.lit(last + dt.timedelta(days=1)).cast("date")
    ts = F.col(column)
    found: Column = (ts >= lo.cast("timestamp_ntz")) & (ts < hi.cast("timestamp_ntz"))
    first, last = first - dt.timedelta(days=2), last + dt.timedelta(days=2)
    if "year" in parts:
        year = F.col("year")
        found &= year.between(first.year, last.year)
        if "month" in parts:
            month = F.col("month")
            found &= (year > first.year) | (month >= first.month)
            found &= (year < last.year) | (month <= last.month)
    return df.where(found)

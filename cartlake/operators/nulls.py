"""Null-key split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.operators.columns import empty_like, require_columns


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def split_nulls(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rows with all of ``columns`` set, and rows with any of them NULL."""
    if not columns:
        return df, empty_like(df)
    require_columns(df, columns)
    missing = any_null(columns)
    return df.where(~missing), df.where(missing)

"""Sums and means that do not depend on the order in which rows arrive, and leave nothing out.

Adding doubles gives different last digits under different partitionings. The values are
added as decimals instead and turned into a double once, at the end. A sum with a value that no
decimal of the chosen places holds, such as NaN, infinity, very large or very fine numbers, is the
plain sum of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN, _MISFITS = "{}__double", "{}__misfits"


def _is_exact(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType))


def _number(df: DataFrame, name: str) -> Column:
    """The column as double; text that is no number is NULL."""
    return F.col(name).try_cast("double")


def exact(df: DataFrame, name: str, scale: int = 10) -> Column:
    """The column as a type that adds up exactly.

    Integers and decimals stay as they are. Doubles are taken by their shortest decimal
    form, to ``scale`` places; they are NULL if they have more places or no such form.
    """
    if _is_exact(df, name):
        return F.col(name)
    decimal = F.col(name).try_cast(T.DecimalType(28, scale))
    return F.when(decimal.cast("double") == _number(df, name), decimal)


def part_names(alias: str) -> list[str]:
    return [alias, _PLAIN.format(alias), _MISFITS.format(alias)]


def sum_parts(df: DataFrame, name: str, alias: str, scale: int = 10) -> list[Column]:
    """Aggregates that ``total(alias)`` makes a sum of, now or after summing them up further."""
    decimal = exact(df, name, scale)
    plain, misfits = F.max(F.lit(0.0)), F.max(F.lit(0).cast("bigint"))
    if not _is_exact(df, name):
        number = _number(df, name)
        plain, misfits = F.sum(number), F.count_if(number.isNotNull() & decimal.isNull())
    return [c.alias(n) for c, n in zip((F.sum(decimal), plain, misfits), part_names(alias))]


def merge_parts(alias: str, where: Column | None = None) -> list[Column]:
    """Aggregates that add up the parts of several groups, or those of the rows ``where`` holds."""
    return [F.sum(F.col(n) if where is None else F.when(where, F.col(n))).alias(n) for n in part_names(alias)]


def total(alias: str) -> Column:
    """The sum as a double, from its parts in the columns of ``alias``."""
    misfits, plain = F.col(_MISFITS.format(alias)), F.col(_PLAIN.format(alias))
    return F.when(F.coalesce(misfits, F.lit(0)) > 0, plain).otherwise(F.col(alias).cast("double"))


def exact_sum(df: DataFrame, name: str, scale: int = 10) -> Column:
    """Sum over a group as a double."""
    decimal = exact(df, name, scale)
    if _is_exact(df, name):
        return F.sum(decimal).cast("double")
    number = _number(df, name)
    misfits = F.count_if(number.isNotNull() & decimal.isNull())
    return F.when(misfits > 0, F.sum(number)).otherwise(F.sum(decimal).cast("double"))


def exact_mean(df: DataFrame, name: str) -> Column:
    """Mean over a group as a double; NULL without values."""
    count = F.count(F.col(name) if _is_exact(df, name) else _number(df, name))
    return exact_sum(df, name) / F.nullif(count, F.lit(0))

"""The narrowest column type that holds every value of two others."""

from __future__ import annotations

from pyspark.sql import types as T

# Decimal digits of the whole number types, narrowest first.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# Types all of whose values a double holds.
_IN_DOUBLE = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type with all values of ``a`` and ``b``; text where no number or time type has them.

    A bigint or decimal does not fit a double, so those are text together. Nested types have
    a common type only if they are equal.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for kind in (a, b):
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE[type(t)])
    if isinstance(a, _IN_DOUBLE) and isinstance(b, _IN_DOUBLE):
        return T.DoubleType()
    digits = [_digits(t) for t in (a, b)]
    if all(digits):
        whole, places = (max(d) for d in zip(*digits))
        return T.DecimalType(whole + places, places) if whole + places <= 38 else T.StringType()
    for kind, other in ((a, b), (b, a)):
        if isinstance(kind, T.DateType) and isinstance(other, _TIMES):
            return other
    return T.StringType()


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (_WHOLE[type(kind)], 0) if type(kind) in _WHOLE else None

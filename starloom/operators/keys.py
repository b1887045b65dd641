"""Keys of unlike types, compared in one type that holds both."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import types as T

# Decimal digits that hold every value of an integral type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def _decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(_DIGITS[type(kind)], 0)


def common_key_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The type in which two keys are compared.

    Integers meet as longs; a decimal meets decimals and integers as a decimal that holds both; a
    fractional number makes it a double; a text is read as the number it meets; a date becomes a
    timestamp. Other pairs, and decimals that would need more than 38 digits, are refused.
    """
    both = (one, other)
    if one == other:
        return one
    if any(isinstance(kind, T.StringType) for kind in both):
        if all(isinstance(kind, T.StringType) for kind in both):
            return T.StringType()
        number = other if isinstance(one, T.StringType) else one
        if isinstance(number, T.IntegralType):
            return T.LongType()
        if isinstance(number, T.NumericType):
            return T.DoubleType() if isinstance(number, T.FloatType) else number
    elif all(isinstance(kind, T.IntegralType) for kind in both):
        return T.LongType()
    elif all(isinstance(kind, T.NumericType) for kind in both):
        if any(isinstance(kind, (T.FloatType, T.DoubleType)) for kind in both):
            return T.DoubleType()
        decimals = [_decimal(kind) for kind in both]
        scale = max(kind.scale for kind in decimals)
        precision = max(kind.precision - kind.scale for kind in decimals) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    elif all(isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) for kind in both):
        zoned = any(isinstance(kind, T.TimestampType) for kind in both)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    raise TypeError(f"keys of types {one.simpleString()} and {other.simpleString()} cannot be compared")


def as_key(key: Column, kind: T.DataType, common: T.DataType) -> Column:
    """A key in the common type; a text that is no number is NULL and has no match."""
    if kind == common:
        return key
    return key.try_cast(common) if isinstance(kind, T.StringType) else key.cast(common)

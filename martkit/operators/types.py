"""Types that a column may widen to without loss."""

from __future__ import annotations

from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
)

# Whole numbers, from narrow to wide, with the decimal digits that hold them.
WHOLE = [(ByteType(), 3), (ShortType(), 5), (IntegerType(), 10), (LongType(), 19)]
DIGITS = dict(WHOLE)
# Whole numbers that a double, or a float, holds exactly.
IN_DOUBLE, IN_FLOAT = 10, 5
MOST_DIGITS = 38


def common_type(one: DataType, other: DataType) -> DataType | None:
    """The narrowest type that holds all values of both exactly; None if there is none.

    Whole numbers widen to longer ones, to decimals with room for them, and if short enough
    to float and double; float to double; decimals to more digits on either side of the
    point; dates to timestamps without a zone. It does not matter which type comes first.
    """
    if one == other:
        return one
    if one in DIGITS and other in DIGITS:
        return max(one, other, key=DIGITS.get)
    for a, b in ((one, other), (other, one)):
        if a in DIGITS and isinstance(b, (FloatType, DoubleType)):
            if isinstance(b, FloatType) and DIGITS[a] <= IN_FLOAT:
                return b
            return DoubleType() if DIGITS[a] <= IN_DOUBLE else None
        if isinstance(a, FloatType) and isinstance(b, DoubleType):
            return b
        if isinstance(a, DateType) and isinstance(b, TimestampNTZType):
            return b
    decimals = [_as_decimal(t) for t in (one, other)]
    if None not in decimals:
        whole = max(d.precision - d.scale for d in decimals)
        scale = max(d.scale for d in decimals)
        return DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else None
    return None


def _as_decimal(kind: DataType) -> DecimalType | None:
    if isinstance(kind, DecimalType):
        return kind
    return DecimalType(DIGITS[kind], 0) if kind in DIGITS else None

"""Types that hold the values of several types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import types as T

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that values of both can be cast to: wider numbers, timestamps for dates, else text.

    Decimals keep all digits before and after the point; where 38 are not enough they are text. With doubles, numbers are
    doubles.
    """
    if a == b:
        return a
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE[type(t)])
    floats = (T.FloatType, T.DoubleType)
    numbers = (*_WHOLE, T.DecimalType, *floats)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, floats) or isinstance(b, floats):
            return T.DoubleType()
        (p, s), (q, r) = ((t.precision, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (a, b))
        scale = max(s, r)
        digits = max(p - s, q - r) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    times = (T.DateType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType()
    return T.StringType()


def common_types(kinds: list[T.DataType]) -> T.DataType:
    return reduce(common_type, kinds)

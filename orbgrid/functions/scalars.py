"""Small value transforms used as post-processing hooks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def invert_sign(v: Column) -> Column:
    return -v


def to_percent(v: Column) -> Column:
    return v * 100


def clamp_negative(v: Column) -> Column:
    """Negatives become 0; missing stays missing."""
    return F.when(v < 0, F.lit(0.0)).otherwise(v)


def nan_to_null(v: Column) -> Column:
    """Floats arrive with NaN as missing; everything here uses NULL."""
    return F.when(~F.isnan(v), v)


def is_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Closeness relative to ``b``; two missing values are not close."""
    return F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))


def order_bits(x: Column | str) -> Column:
    """A long that orders doubles as their numbers: the bits of the magnitude, negative for negative numbers.

    Equal numbers, 0 and -0 among them, get equal keys and others different
    ones.  Exponent and mantissa come from exact divisions by powers of two;
    NaN is above infinity.
    """
    x = F.col(x) if isinstance(x, str) else x
    size, two = F.abs(x), F.lit(2.0)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    # The logarithm may round over a power of two, either way.
    exponent = guess - F.when(F.pow(two, guess) > size, 1).otherwise(0) + F.when(size / F.pow(two, guess) >= 2, 1).otherwise(0)
    mantissa = ((size / F.pow(two, exponent) - 1) * 2.0**52).cast("bigint")
    normal = F.shiftleft((exponent + 1023).cast("bigint"), 52) + mantissa
    tiny = (size * 2.0**537 * 2.0**537).cast("bigint")  # below the smallest normal number
    bits = (
        F.when(F.isnan(x), F.lit(0x7FF8 << 48))
        .when(size == float("inf"), F.lit(0x7FF0 << 48))
        .when(size < 2.0**-1022, tiny)
        .otherwise(normal)
    )
    return F.when(x < 0, -bits).otherwise(bits)

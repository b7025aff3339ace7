"""Numbers as text with a fixed count of decimals, rounded from their exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 2^27 + 1: splits a double into two halves whose products with small integers are exact.
_SPLIT = 134217729.0


def rounded(value: Column, decimals: int) -> Column:
    """``value`` rounded half-even as its exact binary value demands, not as its shortest decimal text suggests.

    The remainder beside one half is taken without error: the two halves of the value times ``2 * 10^decimals`` are exact
    products, and their difference to an odd number near them is exact too.
    """
    x = F.abs(value.cast("double"))
    scale = float(10**decimals)
    big = x * F.lit(_SPLIT)
    high = big - (big - x)
    low = x - high
    whole = F.floor(x * F.lit(scale))
    odd = (whole * F.lit(2) + F.lit(1)).cast("double")
    beyond = (high * F.lit(2 * scale) - odd) + low * F.lit(2 * scale)
    up = (beyond > 0) | ((beyond == 0) & (whole % 2 == 1))
    return F.signum(value) * (whole + up.cast("long")).cast("double") / F.lit(scale)


def fixed(value: Column, decimals: int) -> Column:
    """Text with ``decimals`` decimals.

    A formatter per value is slow, so usual numbers (up to six decimals) are written as decimals; zero, negative and huge ones are formatted.
    """
    text, x = F.format_string(f"%.{decimals}f", rounded(value, decimals)), value.cast("double")
    if decimals > 6:
        return text
    return F.when((x > 0) & (x < 1e6), rounded(value, decimals).cast(f"decimal(18,{decimals})").cast("string")).otherwise(text)

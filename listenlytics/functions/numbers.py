"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FRACTION_BITS = 50


def to_long(value: Column) -> Column:
    """Whole number of a text or number; null instead of an error.

    A fraction is cut off. Whole numbers are read as such, so they are exact beyond 2^53;
    only what is no whole number is read as a decimal.
    """
    return F.coalesce(
        value.try_cast("bigint"), value.try_cast("decimal(38,18)").try_cast("bigint")
    )


def percent_text(rate: Column) -> Column:
    """A rate in [0, 1] as a percentage with one decimal, ties to the even digit.

    ``format_string`` rounds the shortest decimal form half up; here the exact binary
    value of ``rate * 100`` decides. Scaling a double by a power of two loses nothing,
    so the value becomes a fixed-point long whose low bits tell the side of the half.
    """
    unit = 1 << _FRACTION_BITS
    scaled = rate * F.lit(100.0) * F.lit(float(unit))
    whole = scaled.cast("bigint")
    below_unit = (scaled - whole.cast("double")) * 10
    tenfold = whole * F.lit(10).cast("bigint")
    tenths = F.shiftright(tenfold, _FRACTION_BITS)
    side = (tenfold.bitwiseAND(F.lit(unit - 1)) - F.lit(unit >> 1)).cast("double") + below_unit
    round_up = (side > 0) | ((side == 0) & (tenths % 2 == 1))
    rounded = tenths + round_up.cast("bigint")
    return F.format_string("%d.%d%%", F.floor(rounded / 10), rounded % 10)

"""Rounding rules that the catalog's numbers follow."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, places: int) -> Column:
    """Scale, round to the nearest even integer, scale back.

    This is how array libraries round. ``round`` would send 2.5 to 3.
    """
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def round_exact(value: Column, places: int) -> Column:
    """Round by the exact binary value of the double, ties to even.

    Scalar rounding in scripting languages looks at the true binary value, so
    -94.715 (stored slightly below) and 94.705 do not behave like decimal ties.
    The value is split into two parts whose products with 10**places are exact
    in double precision; the sign of what is left decides the direction.
    Exact for \\|value\\| < 2**30 and up to 4 places.
    """
    scale = F.lit(float(10**places))
    grain = F.lit(float(2**20))
    high = F.floor(value * grain).cast("double") / grain
    low = value - high
    below = F.floor(value * scale).cast("double")
    rest = (high * scale - (below + F.lit(0.5).cast("double"))) + low * scale
    odd = F.pmod(below, F.lit(2.0).cast("double")) == F.lit(1.0).cast("double")
    up = (rest > 0) | ((rest == 0) & odd)
    return (below + F.when(up, F.lit(1.0).cast("double")).otherwise(F.lit(0.0).cast("double"))) / scale


def shortest_text(value: Column) -> Column:
    """A double as its shortest decimal text, ``-94.7`` rather than ``-94.70``."""
    return value.cast("string")

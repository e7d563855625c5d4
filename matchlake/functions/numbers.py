"""Exact rounding and time differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(value: Column) -> Column:
    """A duration or count as a decimal, so that sums do not depend on the order of rows."""
    return value.cast("decimal(18,3)")


def half_up(value: Column, places: int) -> Column:
    """Half-up rounding of a decimal, handed out as a double."""
    return F.round(value, places).cast("double")


def ratio(numerator: Column, denominator: Column, places: int, scale_by: int = 1) -> Column:
    """``numerator / denominator * scale_by``, NULL for a zero denominator.

    The quotient of these decimal types keeps 14 digits after the point and 24 before it.
    """
    top = (numerator * F.lit(scale_by)).cast("decimal(24,6)")
    bottom = F.nullif(denominator.cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)"))
    return half_up(top / bottom, places)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds to the microsecond, as a decimal."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(20,6)")


def seconds(micros: Column) -> Column:
    """Microseconds as exact decimal seconds."""
    return (micros.cast("decimal(24,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(24,6)")

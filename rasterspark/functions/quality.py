"""Scalar rules on pixel values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import CLEAR_BITS, DN_HIGH, DN_LOW, DN_OFFSET, DN_SCALE, FLOOR_C, HOT_C, KELVIN, PACK_MAX, PACK_OFFSET, PACK_SCALE


def clear(qa: Column) -> Column:
    """B1: no cloud, cirrus, shadow or snow bit."""
    return qa.bitwiseAND(F.lit(CLEAR_BITS)) == 0


def celsius(dn: Column) -> Column:
    """Count to Celsius; count 0 is missing."""
    return F.when(dn != 0, dn * F.lit(DN_SCALE) + F.lit(DN_OFFSET) - F.lit(KELVIN))


def plausible(dn: Column) -> Column:
    """Within the clamp, as an integer range that a scan can push down."""
    return dn.between(DN_LOW, DN_HIGH)


def encode(c: Column) -> Column:
    """Celsius to packed count, truncated; 0 for missing and what doesn't fit."""
    dn = (c - PACK_OFFSET) / PACK_SCALE
    return F.when(dn.isNotNull() & (dn >= 1) & (F.floor(dn) <= PACK_MAX), F.floor(dn).cast("int")).otherwise(F.lit(0))


def decode(dn: Column) -> Column:
    """B9."""
    return F.when(dn != 0, dn * F.lit(PACK_SCALE) + F.lit(PACK_OFFSET))


def floor_guard(p95: Column, n: Column) -> Column:
    """An observed value below what the packing can hold is missing."""
    return F.when((n > 0) & (p95 < FLOOR_C), None).otherwise(p95)


def gap_drop(p95: Column, in_gap: Column, hot: float = HOT_C) -> Column:
    """Values of ``hot`` degrees or more in a gap are missing."""
    return F.when(in_gap & (p95 >= hot), None).otherwise(p95)


def threshold_dn(t: float, scale: float = PACK_SCALE, offset: float = PACK_OFFSET) -> int:
    """The least packed count at or above a temperature."""
    return math.ceil((t - offset) / scale - 1e-9)


def observation_tier(n: Column) -> Column:
    """Absent, 0, 1, 2, 3 or >=4."""
    return F.when(n < 0, "absent").when(n >= 4, ">=4").otherwise(n.cast("string"))


def coverage_tier(n: Column, water: Column) -> Column:
    """Over land normal (3 and more), low_confidence (1, 2) or gap; null over water."""
    return F.when(water, None).when(n >= 3, "normal").when(n >= 1, "low_confidence").otherwise("gap")


def pixel_state(c: Column, hot: float = HOT_C) -> Column:
    """B15."""
    return F.when(c.isNull(), "missing").when(c >= hot, "hot").otherwise("cool")


def season(month: Column) -> Column:
    """Meteorological season."""
    return F.when(month.isin(12, 1, 2), "DJF").when(month.isin(3, 4, 5), "MAM").when(month.isin(6, 7, 8), "JJA").otherwise("SON")


def summer(month: Column) -> Column:
    """Southern summer."""
    return month.isin(12, 1, 2)

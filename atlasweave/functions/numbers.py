"""Numeric helpers: safe casts, scaling, percentages, bands, band indices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: band index -------------------------------------------------
BEST_QUALITY_LIMIT = 5
BAND_FILL_VALUE = 32767
BAND_SCALE = 0.001

# --- fixed values: missing-data limits in per cent ----------------------------
MISSING_LOW, MISSING_MEDIUM, MISSING_HIGH = 10, 30, 50


def safe_double(col: Column) -> Column:
    """Text that is a decimal number, white space aside -> double; anything else -> null.

    The cast alone would also read type suffixes, hexadecimal numbers and NaN.
    """
    text = F.regexp_replace(col.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def nullable_int(col: Column) -> Column:
    return col.cast("int")


def scale_units(value: Column, variable: Column, factors: Mapping[str, float]) -> Column:
    """Multiply the value of the named variables; null stays null."""
    out = value
    for name, factor in factors.items():
        out = F.when(variable == name, value * F.lit(float(factor))).otherwise(out)
    return out


def percentage(part: Column, total: Column, digits: int = 2) -> Column:
    """``100 * part / total`` rounded; 0 when the total is 0."""
    return F.when(total > 0, F.round(100.0 * part / total, digits)).otherwise(F.lit(0.0))


def quality_band(missing: Column) -> Column:
    """Name of the missing-data band of a percentage."""
    return (
        F.when(missing.isNull(), "unknown")
        .when(missing < MISSING_LOW, "good")
        .when(missing < MISSING_MEDIUM, "usable")
        .when(missing > MISSING_HIGH, "poor")
        .otherwise("partial")
    )


def normalized_difference(
    red: Column,
    nir: Column,
    quality: Column,
    max_quality: int = BEST_QUALITY_LIMIT,
    fill: int = BAND_FILL_VALUE,
    scale: float = BAND_SCALE,
) -> Column:
    """``(nir - red) / (nir + red)`` in [-1, 1]; fill, bad quality or 0/0 -> null."""
    usable = (quality <= max_quality) & (red != fill) & (nir != fill)
    r = F.when(usable, red.cast("double") * scale)
    n = F.when(usable, nir.cast("double") * scale)
    ratio = (n - r) / F.nullif(n + r, F.lit(0.0))
    # greatest/least skip nulls, so the guard keeps a missing ratio missing
    return F.when(ratio.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))

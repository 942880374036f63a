"""Casts and comparisons that keep missing values missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_integer(c: Column) -> Column:
    """Whole number, or null where the value is no integer (``'3'`` -> 3, 1.7 -> 1, ``'1.7'`` -> null)."""
    return c.try_cast("bigint")


def nan_to_null(c: Column) -> Column:
    """NaN becomes null, so that a comparison with it is never true."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def at_least(c: Column, threshold: float) -> Column:
    """``c >= threshold`` with missing or NaN counting as false."""
    return F.coalesce(nan_to_null(c) >= F.lit(float(threshold)), F.lit(False))

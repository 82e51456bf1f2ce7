"""Rounding of KPI columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rounder = Callable[[Column, int], Column]


def half_up(col: Column, digits: int) -> Column:
    """Spark's own HALF_UP rounding; the default of every mart."""
    return F.round(col, digits)


def steady(col: Column, digits: int) -> Column:
    """Half-up with a small nudge, so sums added in another order round alike.

    Use it when a result is compared with one from another engine.
    """
    scale = 10.0**digits
    return F.floor(col * scale + 0.5 + 1e-7) / F.lit(scale)

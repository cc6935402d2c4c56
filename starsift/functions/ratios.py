"""Guarded divisions for metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, and 0 where the bottom is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0)))


def f1_of(tp: Column, predicted: Column, actual: Column) -> Column:
    return ratio(2 * tp, predicted + actual)

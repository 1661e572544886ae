"""Comparisons where NaN is never greater, smaller or equal.

Spark sorts NaN above every number, so a plain ``>`` would treat it as a breach.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def above(left: Column, right: Column) -> Column:
    return (left > right) & ~F.isnan(left)


def below(left: Column, right: Column) -> Column:
    return above(right, left)


def at_least(left: Column, right: Column) -> Column:
    return (left >= right) & ~F.isnan(left)


def is_true(condition: Column) -> Column:
    """The condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))

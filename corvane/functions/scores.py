"""Rounding that is the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(value: Column, places: int = 4) -> Column:
    """floor(value * 10^places + 1/2) as a long: sums in another order differ only beyond that."""
    return F.floor(value * float(10**places) + 0.5).cast("long")


def rounded(value: Column, places: int = 4) -> Column:
    """The same as a double."""
    return F.floor(value * float(10**places) + 0.5) / float(10**places)

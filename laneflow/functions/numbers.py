"""Rounding of stored and printed numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_point(number: Column, places: int) -> Column:
    """A number as text with `places` digits and no grouping.

    Rounds the exact value of the double, ties to the even digit: 2.675, which
    is stored as a little less, gives 2.67. (`round` works on the shortest
    decimal text instead and gives 2.68.)
    """
    pattern = "0" if places == 0 else "0." + "0" * places
    return F.call_function("format_number", number, F.lit(pattern))


def to_places(number: Column, places: int = 2) -> Column:
    """A double rounded like `fixed_point`; NaN and infinite values stay as they are."""
    finite = F.abs(number) < float("inf")
    return F.when(finite, fixed_point(number, places).cast("double")).otherwise(number)

"""Whole-number arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div(number: Column, by: int) -> Column:
    """Quotient without remainder; exact for any long, unlike ``floor(a / b)``."""
    return F.call_function("div", number, F.lit(by))

"""Whole-number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(value: Column, divisor: int) -> Column:
    """Quotient without a remainder, computed on integers so that large values stay exact."""
    return F.call_function("div", value, F.lit(divisor).cast("bigint"))

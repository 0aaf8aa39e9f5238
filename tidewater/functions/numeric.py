"""Numeric functions missing from Spark SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate(x: Column, digits: int = 0) -> Column:
    """Cut toward zero at ``digits`` decimals, exactly (through decimal)."""
    d = x.cast("decimal(28,10)")
    return F.when(d >= 0, F.floor(d, F.lit(digits))).otherwise(F.ceil(d, F.lit(digits)))


def divide_integer(a: Column, b: Column) -> Column:
    """Quotient cut toward zero, in exact integer arithmetic."""
    return F.call_function("div", a, b)


def rand_integer(n: int, seed: int | None = None) -> Column:
    """Uniform integer in [0, n)."""
    return F.floor(F.rand(seed) * n).cast("int")

"""Date and time functions missing from Spark SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units whose value Spark's own EXTRACT gives.
NATIVE_UNITS = {
    "YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "DOY", "HOUR", "MINUTE", "SECOND",
}
# Interval step of one unit, for rounding a timestamp up.
UNIT_STEP = {
    "YEAR": "INTERVAL 1 YEAR", "QUARTER": "INTERVAL 3 MONTH", "MONTH": "INTERVAL 1 MONTH",
    "WEEK": "INTERVAL 7 DAY", "DAY": "INTERVAL 1 DAY", "HOUR": "INTERVAL 1 HOUR",
    "MINUTE": "INTERVAL 1 MINUTE", "SECOND": "INTERVAL 1 SECOND",
}


def _centuries(year: Column, span: int) -> Column:
    return F.ceil(year / F.lit(span)).cast("int")


def extract(unit: str, ts: Column) -> Column:
    """``EXTRACT(unit FROM ts)``. DOW counts from 1 = Sunday, ISODOW from 1 = Monday."""
    u = unit.upper()
    if u in NATIVE_UNITS:
        return F.date_part(F.lit(u), ts)
    year = F.year(ts)
    composed = {
        "DOW": lambda: F.dayofweek(ts),
        "ISODOW": lambda: F.weekday(ts) + 1,
        "ISOYEAR": lambda: F.date_part(F.lit("YEAROFWEEK"), ts),
        "EPOCH": lambda: F.unix_micros(ts.cast("timestamp")) / F.lit(1000000),
        "MILLISECOND": lambda: (F.date_part(F.lit("SECOND"), ts) * 1000).cast("int"),
        "MICROSECOND": lambda: (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("int"),
        "DECADE": lambda: F.floor(year / F.lit(10)).cast("int"),
        "CENTURY": lambda: _centuries(year, 100),
        "MILLENNIUM": lambda: _centuries(year, 1000),
    }
    if u not in composed:
        raise ValueError(f"unknown time unit {unit}")
    return composed[u]()


def floor_to(ts: Column, unit: str) -> Column:
    """``FLOOR(ts TO unit)``."""
    return F.date_trunc(unit, ts)


def ceil_to(ts: Column, unit: str) -> Column:
    """``CEIL(ts TO unit)``: the timestamp itself when it is already aligned."""
    low = F.date_trunc(unit, ts)
    return F.when(low == ts, low).otherwise(low + F.expr(UNIT_STEP[unit.upper()]))


def timestr2long(s: Column) -> Column:
    """Milliseconds since the epoch of a time string; NULL when it is not one."""
    return F.unix_millis(F.try_to_timestamp(s))

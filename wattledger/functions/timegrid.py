"""Column expressions for the 5-minute interval grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the interval grid.
INTERVALS_PER_HOUR = 12
INTERVALS_PER_DAY = 288
MINUTES_PER_INTERVAL = 5


def period_of(ts: Column) -> Column:
    """Period 1..288 of an interval-ending timestamp; midnight closes the day before."""
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    return (
        F.when(minute_of_day == 0, INTERVALS_PER_DAY)
        .otherwise(F.floor(minute_of_day / MINUTES_PER_INTERVAL))
        .cast("int")
    )


def trading_date_of(ts: Column) -> Column:
    """Date an interval-ending timestamp belongs to; midnight belongs to the day before."""
    at_midnight = (F.hour(ts) == 0) & (F.minute(ts) == 0)
    return F.when(at_midnight, F.date_sub(F.to_date(ts), 1)).otherwise(F.to_date(ts))


def year_of(day: str) -> Column:
    return F.year(day).alias("year")


def quarter_of(day: str) -> Column:
    return F.quarter(day).alias("quarter")

"""Time expressions: strings to UTC instants, whole and elapsed days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(x: Column) -> Column:
    """A timestamp of an ISO 8601 text; null where it cannot be read."""
    return F.try_to_timestamp(x)


def elapsed_days(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(86_400_000_000.0)


def age_days(x: Column, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), x.cast("date"))


def iso_week(x: Column) -> Column:
    return F.concat(F.date_format(F.date_sub(x.cast("date"), F.weekday(x.cast("date")) - 3), "yyyy"), F.lit("-W"), F.lpad(F.weekofyear(x).cast("string"), 2, "0"))


def stale(age: Column, most: int) -> Column:
    """Whether an age is above a number of days; an unknown age is stale."""
    return F.coalesce(age > most, F.lit(True))

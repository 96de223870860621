"""Compositing windows and their dates, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Timesteps of a year.
PER_YEAR = {"month": 12, "dekad": 36}


def align(date: Column, frequency: str) -> Column:
    """The first day of the date's window: day 1, or 1, 11 or 21."""
    if frequency not in PER_YEAR:
        raise ValueError(f"unknown frequency: {frequency}")
    date = F.to_date(date)
    if frequency == "month":
        return F.trunc(date, "MM").cast("date")
    day = F.dayofmonth(date)
    start = F.when(day <= 10, 1).when(day <= 20, 11).otherwise(21)
    return F.make_date(F.year(date), F.month(date), start)


def timesteps_per_year(frequency: Column) -> Column:
    """Timesteps of a year by the name of a frequency; null for another."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in PER_YEAR.items() for x in pair]), frequency)


def timestamps(start: Column, end: Column, frequency: str) -> Column:
    """An array of (day, month, year): the windows from that of ``start`` to that of ``end``."""
    first, last = align(start, frequency), align(end, frequency)
    months = F.sequence(F.trunc(first, "MM").cast("date"), F.trunc(last, "MM").cast("date"), F.expr("interval 1 month"))
    if frequency == "month":
        days = months
    else:
        days = F.flatten(
            F.transform(months, lambda m: F.array(m, F.date_add(m, 10), F.date_add(m, 20)))
        )
        days = F.filter(days, lambda d: (d >= first) & (d <= last))
    return F.transform(
        days,
        lambda d: F.struct(
            F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year")
        ),
    )

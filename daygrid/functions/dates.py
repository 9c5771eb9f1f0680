"""Calendar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sunday_week(day: Column) -> Column:
    """Week of the year with Sunday as first day; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def iso_weekday(day: Column) -> Column:
    """1 for Monday up to 7 for Sunday."""
    return F.weekday(day) + 1


def week_day(year: Column, week: Column, weekday: int) -> Column:
    """Date of an ISO weekday of a Sunday week; outside the year in weeks at its ends."""
    opening = F.make_date(year, F.lit(1), F.lit(1))
    first_sunday = F.date_add(opening, (8 - F.dayofweek(opening)) % 7)
    return F.date_add(first_sunday, (7 * (week - 1) + weekday).cast("int"))


def is_workday(day: Column) -> Column:
    return F.weekday(day) < 5


def first_workday(month_start: Column) -> Column:
    """First Monday-to-Friday date of the month that starts on ``month_start``."""
    return (
        F.when(F.weekday(month_start) == 5, F.date_add(month_start, 2))
        .when(F.weekday(month_start) == 6, F.date_add(month_start, 1))
        .otherwise(month_start)
    )


def month_week(day: Column) -> Column:
    """1-based block of ``day`` among the weeks of its month that have a workday.

    Sunday weeks of one month are consecutive, so the rank of a week is a
    difference and needs no window. Defined for workdays.
    """
    return sunday_week(day) - sunday_week(first_workday(F.trunc(day, "month"))) + 1


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def rows_of_year(dated: DataFrame, year: int | None) -> DataFrame:
    """The rows of one year as a date range, which scans can use; all rows without a year."""
    if year is None:
        return dated
    start, end = (F.make_date(F.lit(year), F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
    return dated.where(F.col("session_date").between(start, end))

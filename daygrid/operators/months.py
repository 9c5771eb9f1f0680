"""Month tables: titles, day numbers and workdays."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.functions.dates import (
    days_in_month,
    first_workday,
    is_workday,
    iso_weekday,
    month_name,
    month_week,
    sunday_week,
)
from daygrid.operators.checks import presiding_count

WORKDAYS = ("mon", "tue", "wed", "thu", "fri")
# The text of cells outside the month, and the title templates.
PAD = "Empty"
TITLE_TEMPLATES = {
    "sheet_name": "${calendar_month_name}$ ${calendar_year}$",
    "title": "${calendar_month_name}$ ${calendar_year}$ Master Calendar",
    "subtitle": "Presiding: ${superior_judge}$",
}


def calendar_years(dated: DataFrame) -> DataFrame:
    """The (calendar, year) pairs that have dates."""
    return dated.select("calendar_id", F.year("session_date").alias("year")).distinct()


def months_of(years: DataFrame) -> DataFrame:
    """Twelve months per calendar year, with their first day."""
    return years.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    ).withColumn("month_start", F.make_date("year", "month", F.lit(1)))


def workdays_of(years: DataFrame) -> DataFrame:
    """Every workday of the years, with its month, week and place in the grid."""
    days = years.select(
        "*",
        F.explode(
            F.sequence(
                F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
            )
        ).alias("session_date"),
    )
    day = F.col("session_date")
    return days.where(is_workday(day)).select(
        "*",
        F.month(day).alias("month"),
        sunday_week(day).alias("week"),
        iso_weekday(day).alias("dow"),
        month_week(day).alias("week_block"),
    )


def _fill(template: str, values: Mapping[str, Column]) -> Column:
    text = F.lit(template)
    for placeholder, value in values.items():
        text = F.replace(text, F.lit(placeholder), value)
    return text


def month_titles(
    years: DataFrame, presiding: DataFrame, templates: Mapping[str, str] = TITLE_TEMPLATES
) -> DataFrame:
    """Sheet name, title and subtitle of each month.

    The presiding officers take turns by month, in the order of ``seq``, which may have gaps.
    """
    count = presiding_count(presiding)
    months = months_of(years).withColumn("turn", (F.col("month") - 1) % count)
    # A list of officers is configuration: a window over all of it is one of few rows.
    turn = F.row_number().over(Window.orderBy("seq", "name")) - 1
    turns = presiding.select(turn.alias("turn"), F.col("name").alias("presiding"))
    named = months.join(turns, "turn", "left")
    start = F.col("month_start")
    dated = {
        "${calendar_month_name}$": month_name(start),
        "${calendar_year}$": F.col("year").cast("string"),
    }
    return named.select(
        "calendar_id",
        "year",
        "month",
        month_name(start).alias("month_name"),
        days_in_month(start).alias("days_in_month"),
        "presiding",
        _fill(templates["sheet_name"], dated).alias("sheet_name"),
        _fill(templates["title"], dated).alias("title"),
        _fill(templates["subtitle"], {"${superior_judge}$": F.col("presiding")}).alias("subtitle"),
    )


def month_day_grid(years: DataFrame) -> DataFrame:
    """Day numbers of each month by week and weekday, with pads outside the month.

    Each row is made from its Monday, so the grid needs neither shuffle nor pivot.
    """
    start = F.col("month_start")
    opening = first_workday(start)
    mondays = F.sequence(
        F.date_sub(opening, F.weekday(opening)), F.last_day(start), F.expr("interval 7 days")
    )
    weeks = months_of(years).select(
        "*", F.posexplode(mondays).alias("_index", "monday")
    )

    def cell(offset: int) -> Column:
        day = F.date_add("monday", offset)
        inside = F.trunc(day, "month") == start
        return F.when(inside, F.dayofmonth(day).cast("string")).otherwise(PAD)

    return weeks.select(
        "calendar_id",
        "year",
        "month",
        (sunday_week(opening) + F.col("_index")).alias("week"),
        (F.col("_index") + 1).alias("week_block"),
        *[cell(offset).alias(name) for offset, name in enumerate(WORKDAYS)],
    )

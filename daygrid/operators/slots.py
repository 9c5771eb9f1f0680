"""Week slots of banners, and their alignment over the days of the week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import is_workday
from daygrid.operators.items import ITEM_COLUMNS, with_week
from daygrid.operators.ranking import ascending, row_numbers

WEEK_KEYS = ("calendar_id", "year", "week")
# Order of blank slot rows and slot number of timed items.
BLANK_ORDER = 999
TIMED_ROW_NUM = 9999

SLOTTED_COLUMNS = (*ITEM_COLUMNS, "year", "week", "row_num")


def banner_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("start_time") == "")


def timed_items(items: DataFrame) -> DataFrame:
    """Everything that is not a banner; an item without any start time counts as timed."""
    return items.where(~F.col("start_time").eqNullSafe(""))


def week_slots(items: DataFrame) -> DataFrame:
    """Distinct banner texts of each week, numbered through the calendar year.

    ``slot_pos`` is the number within the week and ``row_num`` the one within the year.
    """
    slots = banner_items(items).select(*WEEK_KEYS, "display_order", "description").distinct()
    return row_numbers(
        slots,
        {"slot_pos": WEEK_KEYS, "row_num": ("calendar_id", "year")},
        ["week", "display_order", "description"],
        ["week", "display_order", "left(description, 8)"],
    )


def spine_bounds(dated: DataFrame) -> DataFrame:
    """First and last date of each calendar year."""
    year = F.year("session_date").alias("year")
    return dated.groupBy("calendar_id", year).agg(
        F.min("session_date").alias("lo"), F.max("session_date").alias("hi")
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """Workdays between the first and the last date of each calendar year."""
    days = bounds.select("calendar_id", F.explode(F.sequence("lo", "hi")).alias("session_date"))
    return with_week(days.where(is_workday(F.col("session_date"))))


def banner_rank() -> Column:
    """What tells the banner that a date shows for a description: lowest order, then colour and
    officer. The null flags sort nulls last in a minimum."""
    return F.struct(
        F.col("display_order").isNull().alias("no_order"),
        "display_order",
        F.col("color").isNull().alias("no_color"),
        "color",
        F.col("officer_code").isNull().alias("no_officer"),
        "officer_code",
    )


def slot_aligned(days: DataFrame) -> DataFrame:
    """Every slot of the week on every spine day: the day's banner, or a blank row.

    ``days`` are the week rows' days. ``slot_pos`` stays for placing the rows in the day.
    """
    found = F.col("cell").isNotNull()
    return days.select(
        "calendar_id",
        "session_date",
        F.lit("").alias("start_time"),
        F.when(found, F.col("description")).otherwise("").alias("description"),
        F.when(found, F.col("cell.color")).otherwise("").alias("color"),
        F.when(found, F.col("cell.officer_code")).otherwise("").alias("officer_code"),
        F.when(found, F.col("cell.display_order")).otherwise(BLANK_ORDER).alias("display_order"),
        "year",
        "week",
        "row_num",
        "slot_pos",
    )


def days_with_rows(slots: DataFrame, timed: DataFrame, spine: DataFrame) -> DataFrame:
    """Distinct days that have slotted rows, from key columns alone."""
    keys = ["calendar_id", "session_date"]
    aligned = spine.join(slots.select(*WEEK_KEYS).distinct(), [*WEEK_KEYS], "left_semi")
    return aligned.select(*keys).unionByName(timed.select(*keys)).distinct()


def slotted(aligned: DataFrame, items: DataFrame) -> DataFrame:
    """Aligned slots (kind 0) and timed items (kind 1) in one list."""
    timed = timed_items(items).withColumn("row_num", F.lit(TIMED_ROW_NUM))
    return (
        aligned.select(*SLOTTED_COLUMNS, F.lit(0).alias("kind"))
        .unionByName(timed.select(*SLOTTED_COLUMNS, F.lit(1).alias("kind")))
    )


def in_order(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Global display order, nulls last."""
    return frame.orderBy(*ascending(columns))

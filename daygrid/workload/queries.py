"""Registered queries: each takes a session and a folder of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.dates import iso_weekday, sunday_week
from daygrid.functions.text import abbreviate
from daygrid.operators import checks, items, layout, months, rulematch, wording
from daygrid.operators.slots import in_order
from daygrid.plans.staging import new_scratch_path
from daygrid.sinks.tables import register, replace_table, write_months
from daygrid.sources.dimensions import special_days as special_days_of
from daygrid.sources.sessions import read_csv_rejects, read_sessions_csv
from daygrid.workload import adapter
from daygrid.workload.adapter import calendar, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


@query
def items_officer_join(spark, sf_dir):
    return items.with_officers(adapter.sessions(spark, sf_dir), adapter.officers(spark, sf_dir))


@query
def items_rule_match(spark, sf_dir):
    return items.match_rules(adapter.sessions(spark, sf_dir), adapter.RULES)


@query
def items_rule_match_distinct(spark, sf_dir):
    return rulematch.match_rule_table(adapter.sessions(spark, sf_dir), adapter.rules(spark))


@query
def item_labels(spark, sf_dir):
    return items.label_items(items.match_rules(items_officer_join(spark, sf_dir), adapter.RULES))


@query
def special_days(spark, sf_dir):
    return items.special_items(special_days_of(adapter.specials(spark, sf_dir)))


@query
def calendar_items(spark, sf_dir):
    return calendar(spark, sf_dir).unstaged_items


@query
def calendar_items_one_year(spark, sf_dir):
    return calendar(spark, sf_dir, year=2024).unstaged_items


@query
def week_slots(spark, sf_dir):
    slots = calendar(spark, sf_dir).unstaged_week_slots
    return in_order(slots, ["calendar_id", "row_num"]).drop("slot_pos")


@query
def date_spine(spark, sf_dir):
    return calendar(spark, sf_dir).date_spine


@query
def slot_aligned(spark, sf_dir):
    return calendar(spark, sf_dir).slot_aligned.drop("slot_pos")


@query
def slotted_all(spark, sf_dir):
    keys = ["session_date", "kind", "row_num", "display_order", "start_time", "description"]
    return in_order(calendar(spark, sf_dir).slotted, ["calendar_id", *keys])


@query
def week_of_year_orders(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("order_date"),
        sunday_week(day).alias("week"),
        iso_weekday(day).alias("weekday"),
    )


@query
def abbreviate_text(spark, sf_dir):
    return wording.abbreviate_timed(
        calendar(spark, sf_dir).unstaged_items, adapter.ABBREVIATIONS
    )


@query
def abbreviate_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", abbreviate(F.col("text"), adapter.DOCUMENT_ABBREVIATIONS).alias("text")
    )


@query
def item_colors(spark, sf_dir):
    plan = calendar(spark, sf_dir)
    cells = layout.paint(layout.decode(plan.worded(plan.unstaged_items)))
    return cells.select(
        "calendar_id", "session_date", "tagged", "text", "role", "fill_argb", "font_argb"
    )


@query
def unknown_colors(spark, sf_dir):
    return checks.unknown_colors(
        calendar(spark, sf_dir).unstaged_items, adapter.PARTIAL_PALETTE
    )


@query
def month_titles(spark, sf_dir):
    return calendar(spark, sf_dir).month_titles


@query
def month_day_grid(spark, sf_dir):
    return months.month_day_grid(calendar(spark, sf_dir).years)


@query
def day_positions(spark, sf_dir):
    return calendar(spark, sf_dir).calendar_positions


@query
def month_item_grid(spark, sf_dir):
    return calendar(spark, sf_dir).item_grid


@query
def span_runs(spark, sf_dir):
    return calendar(spark, sf_dir).span_runs


@query
def compacted_cells(spark, sf_dir):
    return calendar(spark, sf_dir).compacted_cells.select(
        *layout.BLOCK_KEYS, "dow", "new_pos", "text", "argb", "role", "span_first", "span_days"
    )


@query
def final_grid(spark, sf_dir):
    return calendar(spark, sf_dir).final_grid


@query
def month_files_roundtrip(spark, sf_dir):
    """The grid from its month folders."""
    path = new_scratch_path(spark, "months")
    grid = calendar(spark, sf_dir).final_grid
    write_months(grid, path)
    return spark.read.schema(grid.schema).parquet(path)


@query
def month_sheets(spark, sf_dir):
    """Grid and titles of all months, written in one call and read from their folders."""
    path = new_scratch_path(spark, "sheets")
    sheets = calendar(spark, sf_dir).sheets
    write_months(sheets, path)
    return spark.read.schema(sheets.schema).parquet(path)


@query
def replaced_table_roundtrip(spark, sf_dir):
    """Week slots from a table that replaced one of another form, through a view."""
    path = new_scratch_path(spark, "tables")
    plan = calendar(spark, sf_dir)
    replace_table(plan.date_spine, "daygrid_replaced", f"{path}/first")
    replace_table(plan.unstaged_week_slots.drop("slot_pos"), "daygrid_replaced", f"{path}/second")
    register(spark.table("daygrid_replaced"), "daygrid_replaced_view")
    return spark.sql("SELECT * FROM daygrid_replaced_view")


@query
def csv_rejects(spark, sf_dir):
    """Lines of an extract by what becomes of them; some have too few or too many fields, some
    no date or an unreadable one."""
    path = new_scratch_path(spark, "broken")
    adapter.extract_lines(spark, sf_dir).write.text(path)
    rejects = read_csv_rejects(spark, path).select("reason")
    accepted = read_sessions_csv(spark, path).select(F.lit("accepted").alias("reason"))
    return accepted.unionByName(rejects).groupBy("reason").agg(F.count("*").alias("n_lines"))


@query
def csv_sessions(spark, sf_dir):
    """Round trip through a headerless extract in the shared scratch folder."""
    path = new_scratch_path(spark, "csv")
    adapter.sessions(spark, sf_dir).select(
        "session_date",
        "start_time",
        "description",
        F.col("calendar_id").alias("calendar_name"),
        "officer_code",
        F.concat(F.lit("Officer, "), F.col("officer_code")).alias("officer_name"),
    ).write.csv(path, header=False, escape='"')
    return read_sessions_csv(spark, path)

"""Banners as week rows: one row per slot of a week, with an array of its five days.

The first banners of all days come from one aggregation over week and text. A row knows by
itself which of its days merge, so positions, the rows left when blank ones go, and the moves
of compaction are running sums and maxima over the rows of a week, taken in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import iso_weekday, week_day
from daygrid.functions.text import TAG_FIND, TAG_STRIP
from daygrid.operators.months import PAD, WORKDAYS
from daygrid.operators.ranking import running_state
from daygrid.operators.slots import WEEK_KEYS, banner_items, banner_rank
from daygrid.operators.wording import strict_argb

DAYS = range(len(WORKDAYS))
# Two halves of a week: days in the month of its Friday (0), and in the month before (1).
SIDE = "if(month({day}) = month({friday}), 0, 1)"
# Texts compare by bytes, so these begin with a digit.
_DIGIT_FIRST = "({text} >= '0' AND {text} < ':')"
# A text that may merge with an equal neighbour.
_MERGES = f"c.tagged <> '' AND c.tagged <> '{PAD}' AND NOT {_DIGIT_FIRST.format(text='c.tagged')}"
# A text without tags of its own has the one that was just put on it.
_PLAIN = "instr(description, '-[') = 0 AND instr(get(argbs, i), ']') = 0 AND get(argbs, i) <> ''"
_ARGB = f"if({_PLAIN}, get(argbs, i), nullif(regexp_extract(c.tagged, r'{TAG_FIND}', 1), ''))"


def with_runs(rows: DataFrame) -> DataFrame:
    """Adds ``begins`` and ``lengths`` to rows with an array ``cells`` of (tagged, side): for each
    cell, the number from 1 of the first cell of its run, and how long the run is.

    Equal neighbours of one side join. Blank, pad and digit-first texts do not.
    """
    linked = (
        "transform(cells, (c, i) -> coalesce(i > 0 AND c.tagged = get(cells, i - 1).tagged "
        f"AND c.side = get(cells, i - 1).side AND {_MERGES}, false))"
    )
    begins = (
        "aggregate(linked, cast(array() AS array<int>), "
        "(made, l) -> array_append(made, if(l, element_at(made, -1), size(made) + 1)))"
    )
    return (
        rows.withColumn("linked", F.expr(linked))
        .withColumn("begins", F.expr(begins))
        .withColumn("lengths", F.expr("transform(begins, b -> size(filter(begins, x -> x = b)))"))
        .drop("linked")
    )


def banner_weeks(items: DataFrame) -> DataFrame:
    """The first banner of each workday, and the orders, of every text of a week.

    Minima of structs combine before the shuffle. A text has few orders in a week: rules and
    special days give them.
    """
    ranked = banner_items(items).select(
        *WEEK_KEYS, "description", "display_order", banner_rank().alias("rank"),
        (iso_weekday(F.col("session_date")) - 1).alias("day"),
    )
    firsts = ", ".join(f"min(if(day = {k}, rank, null))" for k in DAYS)
    return ranked.groupBy(*WEEK_KEYS, "description").agg(
        F.expr(f"array({firsts})").alias("firsts"),
        F.expr("collect_set(struct(display_order))").alias("orders"),
    )


def _with_cells(weeks: DataFrame, palette: Mapping[str, str]) -> DataFrame:
    """Adds the Monday and the tagged, decoded texts of the five days, with their runs."""
    dated = weeks.withColumn("monday", week_day(F.col("year"), F.col("week"), 1))
    friday = f"date_add(monday, {DAYS[-1]})"
    shown = F.expr("coalesce(description, '') <> ''")
    # The palette is looked up once a day, by the name that the first banner gives.
    coloured = dated.withColumn(
        "argbs", F.transform("firsts", lambda f: F.when(f.isNotNull() & shown, strict_argb(f["color"], palette)))
    )
    cells = (
        "transform(firsts, (f, i) -> named_struct("
        f"'side', {SIDE.format(day='date_add(monday, i)', friday=friday)}, "
        "'tagged', if(coalesce(description, '') <> '', "
        "concat(description, '-[', get(argbs, i), ']'), null)))"
    )
    decoded = (
        "transform(cells, (c, i) -> if(c.tagged IS NULL, null, named_struct("
        f"'argb', {_ARGB}, "
        f"'text', if({_PLAIN}, description, "
        f"if({_ARGB} IS NULL, c.tagged, regexp_replace(c.tagged, r'{TAG_STRIP}', ''))), "
        "'wall', get(lengths, i) > 1)))"
    )
    return (
        with_runs(coloured.withColumn("cells", F.expr(cells)))
        .withColumn("decoded", F.expr(decoded))
        .withColumn(
            "movers", F.expr("transform(decoded, d -> coalesce(NOT d.wall AND d.text <> '', false))")
        )
        .withColumn(
            "shown",
            F.expr("transform(array(0, 1), s -> exists(cells, c -> c.tagged IS NOT NULL AND c.side = s))"),
        )
    )


_DAY_CELLS = """
    transform(firsts, (f, i) -> if(f IS NULL, null, named_struct(
      'color', f.color,
      'officer_code', f.officer_code,
      'display_order', f.display_order,
      'tagged', get(cells, i).tagged,
      'pos', if(get(cells, i).tagged IS NULL, null, get(heights, get(cells, i).side)),
      'span_first', if(get(decoded, i).wall, get(begins, i), null),
      'span_days', if(get(decoded, i).wall, get(lengths, i), null),
      'text', get(decoded, i).text,
      'argb', get(decoded, i).argb,
      'role', if(get(decoded, i).argb IS NULL, null,
                 if({digit}, 'timed', 'banner')),
      'new_pos', CASE WHEN get(decoded, i).wall THEN get(heights, get(cells, i).side)
                      WHEN get(movers, i) THEN get(heights, get(cells, i).side) - get(rises, i) END)))
"""


def week_rows(items: DataFrame, palette: Mapping[str, str]) -> DataFrame:
    """One row per slot: its numbers, order and text, its ``monday``, and ``days``, the cells of
    Monday to Friday; a day without the banner is null.

    ``slot_pos`` counts the slots of the week, ``row_num`` those of the year. ``rows_0`` and
    ``rows_1`` count the rows that show something in the month of the week's Friday and in the
    month before it: a cell's ``pos``. Within a day the cells of runs are walls. Above the first
    wall and between walls the other cells move up: each by the rows of which its day has no
    such cell (``gaps``), but for those up to the last wall (``floor``). Cells that vanish, as
    nothing is left of their text but tags, have no ``new_pos``.
    """
    slots = _with_cells(
        banner_weeks(items).select("*", F.inline("orders")).drop("orders"), palette
    )
    year = ("calendar_id", "year")
    placed = running_state(
        slots,
        order=["week", "display_order", "description"],
        pieces=["week", "display_order", "left(description, 8)"],
        sums={
            "slot_pos": (WEEK_KEYS, "1"),
            "row_num": (year, "1"),
            **{f"rows_{side}": (WEEK_KEYS, f"int(shown[{side}])") for side in (0, 1)},
            **{
                f"gaps_{k}": (WEEK_KEYS, f"int(shown[cells[{k}].side]) - int(movers[{k}])")
                for k in DAYS
            },
        },
        tops={f"floor_{k}": (f"gaps_{k}", f"decoded[{k}].wall") for k in DAYS},
    )
    rises = ", ".join(f"int(gaps_{k} - coalesce(floor_{k}, 0))" for k in DAYS)
    lifted = placed.selectExpr(
        "*", "array(int(rows_0), int(rows_1)) AS heights", f"array({rises}) AS rises"
    )
    return lifted.selectExpr(
        *WEEK_KEYS, "monday", "display_order", "description",
        *[f"int({name}) AS {name}" for name in ("slot_pos", "row_num", "rows_0", "rows_1")],
        _DAY_CELLS.format(digit=_DIGIT_FIRST.format(text="get(cells, i).tagged")) + " AS days",
    )


def week_sizes(rows: DataFrame) -> DataFrame:
    """Slots of every week, shown rows in its two months, and the last position of each day."""
    lasts = ", ".join(f"max(days[{k}].new_pos)" for k in DAYS)
    return rows.groupBy(*WEEK_KEYS).agg(
        F.max("slot_pos").alias("slots"),
        F.max("rows_0").alias("rows_0"),
        F.max("rows_1").alias("rows_1"),
        F.expr(f"array({lasts})").alias("lasts"),
    )


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", "posexplode(days) AS (day, cell)").selectExpr(
        "* EXCEPT (day, days)", "day + 1 AS dow", "date_add(monday, day) AS session_date"
    )


def aligned_days(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every slot on every workday between the year's first and last date, by ``bounds``."""
    return _by_day(rows.join(bounds, ["calendar_id", "year"])).where("session_date BETWEEN lo AND hi")


def banner_cells(rows: DataFrame) -> DataFrame:
    """Non-blank cells of week rows, one row each."""
    return _by_day(rows).where("cell.tagged IS NOT NULL").selectExpr(
        "calendar_id", "year", "month(session_date) AS month", "week", "session_date", "dow",
        *[
            f"cell.{name} AS {name}"
            for name in ("pos", "tagged", "span_first", "span_days", "text", "argb", "role", "new_pos")
        ],
    )


def banner_grid(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Slot rows of the weekday grid, by month, blank ones included: a week row is at most two."""
    side = SIDE.format(day="date_add(monday, i)", friday=f"date_add(monday, {DAYS[-1]})")
    inside = f"{side} = s AND date_add(monday, i) BETWEEN lo AND hi"
    halves = (
        "inline(transform(array(0, 1), s -> named_struct("
        f"'month', array_max(transform(days, (c, i) -> if({inside}, month(date_add(monday, i)), null))), "
        f"'texts', transform(days, (c, i) -> if({inside}, "
        "if(c IS NULL, '', coalesce(c.tagged, description)), null)))))"
    )
    grid = rows.join(bounds, ["calendar_id", "year"]).selectExpr(*WEEK_KEYS, "slot_pos AS pos", halves)
    return grid.where("month IS NOT NULL").selectExpr(
        "calendar_id", "year", "month", "week", "pos",
        *[f"texts[{k}] AS {name}" for k, name in enumerate(WORKDAYS)],
    )

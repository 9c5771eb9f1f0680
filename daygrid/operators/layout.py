"""Placing items in the weekday grid: positions, merged runs, compaction, rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrid.functions.dates import is_workday, iso_weekday, month_week
from daygrid.functions.text import cell_role, tag_argb, untag
from daygrid.operators.months import WORKDAYS
from daygrid.operators.ranking import (
    block_of,
    cut_points,
    hot_pieces,
    row_numbers,
    with_share,
)
from daygrid.operators.slots import TIMED_ROW_NUM, WEEK_KEYS
from daygrid.operators.weekrows import with_runs

DAY_KEYS = ("calendar_id", "session_date")
BLOCK_KEYS = ("calendar_id", "year", "month", "week")
ROW_KEYS = (*BLOCK_KEYS, "pos")
# Fields of a cell, and the suffix of their columns in a grid row.
CELL_PARTS = (("text", ""), ("argb", "_argb"), ("role", "_role"), ("span", "_span"))
TIMED_PIECE = (*DAY_KEYS, "display_order", "start_time")
TIMED_ORDER = ("display_order", "start_time", "description", "color", "officer_code")


def on_workdays(dated: DataFrame) -> DataFrame:
    """Rows that have a place in the grid, with month and weekday."""
    day = F.col("session_date")
    return dated.where(is_workday(day)).withColumns(
        {"month": F.month(day), "dow": iso_weekday(day)}
    )


def timed_cuts(timed: DataFrame, parts: int) -> DataFrame | None:
    """Where to divide the items of one day, order and start time that are more than one of
    ``parts`` of all; nothing if there are none. Fewer than ``parts`` rows reach the driver."""
    hot = hot_pieces(timed, TIMED_PIECE, parts)
    found = hot.collect()
    if not found:
        return None
    few = timed.sparkSession.createDataFrame(found, hot.schema)
    return cut_points(timed, few, TIMED_PIECE, TIMED_ORDER, parts)


def timed_positions(timed: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """Adds ``timed_pos``, the place of a timed item among those of its day. ``cuts`` are a table
    of `timed_cuts`: both branches of the numbering must see the same ones."""
    pieces = ["display_order", "start_time"]
    if cuts is None:
        return row_numbers(timed, {"timed_pos": DAY_KEYS}, TIMED_ORDER, pieces)
    shared = with_share(timed, cuts, TIMED_PIECE, TIMED_ORDER)
    numbered = row_numbers(shared, {"timed_pos": DAY_KEYS}, TIMED_ORDER, [*pieces, "share"])
    return numbered.drop("share")


def day_positions(aligned: DataFrame, timed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every slotted row with its position in the day: slots first, then timed items.

    All workdays of a week have all its slots, so a slot's position is its
    number within the week and timed items follow after the week's slot count.
    ``timed`` has ``timed_pos`` and ``sizes`` the ``slots`` of each week.
    """
    placed = aligned.withColumnRenamed("slot_pos", "pos").withColumn("kind", F.lit(0))
    follows = (
        timed.join(sizes.select(*WEEK_KEYS, "slots"), [*WEEK_KEYS], "left")
        .withColumns(
            {
                "row_num": F.lit(TIMED_ROW_NUM),
                "pos": F.coalesce("slots", F.lit(0)) + F.col("timed_pos"),
                "kind": F.lit(1),
            }
        )
        .select(*placed.columns)
    )
    return placed.unionByName(follows)


def on_calendar(workdays: DataFrame, positioned: DataFrame, present: DataFrame) -> DataFrame:
    """Every workday with its positioned rows; days without any keep one row of nulls.

    Positioned rows get their place in the month by date arithmetic, so that they
    need no join. Only the days that are not ``present`` are looked up.
    """
    filled = on_workdays(positioned).withColumn("week_block", month_week(F.col("session_date")))
    empty = workdays.join(present, [*DAY_KEYS], "left_anti")
    return filled.unionByName(empty, allowMissingColumns=True)


def item_grid(cells: DataFrame, value: str = "tagged") -> DataFrame:
    """One row per week and position, one column per weekday."""
    return cells.groupBy(*ROW_KEYS).agg(
        *[
            F.max(F.when(F.col("dow") == number, F.col(value))).alias(name)
            for number, name in enumerate(WORKDAYS, start=1)
        ]
    )


def mark_spans(cells: DataFrame) -> DataFrame:
    """Adds ``span_first`` and ``span_days`` to cells in a run of equal neighbours.

    The cells of a row, five at most, meet in one aggregation and runs are found within it.
    """
    own = [c for c in cells.columns if c not in (*ROW_KEYS, "dow")]
    days = range(1, len(WORKDAYS) + 1)
    dealt = cells.select(*ROW_KEYS, "dow", F.struct(*own).alias("cell"))
    held = ", ".join(f"max(if(dow = {k}, cell, null))" for k in days)
    rows = dealt.groupBy(*ROW_KEYS).agg(F.expr(f"array({held})").alias("held"))
    cells_of = "transform(held, h -> named_struct('side', 0, 'tagged', h.tagged))"
    marked = with_runs(rows.withColumn("cells", F.expr(cells_of))).selectExpr(
        *ROW_KEYS, "begins", "lengths", "posexplode(held) AS (day, cell)"
    )
    return marked.where("cell IS NOT NULL").selectExpr(
        *[c if c in ROW_KEYS else "day + 1 AS dow" if c == "dow" else f"cell.{c} AS {c}" for c in cells.columns],
        "if(lengths[day] > 1, begins[day], null) AS span_first",
        "if(lengths[day] > 1, lengths[day], null) AS span_days",
    )


def span_runs(spanned: DataFrame) -> DataFrame:
    """The merged runs, one row each."""
    return spanned.where(F.col("span_days").isNotNull() & (F.col("dow") == F.col("span_first"))).select(
        *ROW_KEYS,
        F.col("span_first").alias("first_dow"),
        (F.col("span_first") + F.col("span_days") - 1).alias("last_dow"),
        F.col("span_days").alias("n_days"),
        "tagged",
    )


def decode(cells: DataFrame) -> DataFrame:
    """Splits the tagged text into text, colour and role."""
    tagged = F.col("tagged")
    return cells.withColumns(
        {"text": untag(tagged), "argb": tag_argb(tagged), "role": cell_role(tagged)}
    )


def paint(decoded: DataFrame) -> DataFrame:
    """Colour of the background for banners, of the letters for timed texts."""
    return decoded.withColumns(
        {
            "fill_argb": F.when(F.col("role") == "banner", F.col("argb")),
            "font_argb": F.when(F.col("role") == "timed", F.col("argb")),
        }
    )


def wide_rows(cells: DataFrame) -> DataFrame:
    """Grid rows from cells: text, colour, role and span of each weekday, and the row's ``piece``.

    Only the first cell of a span shows its text. At most five cells meet in a row. Cells are dealt
    by week and piece of positions, so rows are made and later numbered in the same place.
    """
    shown = "span_days IS NULL OR dow = span_first"
    fields = {"text": "text", "argb": "argb", "role": "role", "span": "coalesce(span_days, 1)"}
    cell = ", ".join(f"'{name}', if({shown}, {value}, null)" for name, value in fields.items())
    dealt = cells.select(
        *BLOCK_KEYS, block_of("new_pos").alias("piece"), F.col("new_pos").alias("pos"), "dow",
        F.expr(f"named_struct({cell})").alias("cell"),
    ).repartition(*BLOCK_KEYS, "piece")
    rows = dealt.groupBy(*BLOCK_KEYS, "piece", "pos").agg(
        *[F.expr(f"max(if(dow = {n}, cell, null)) AS {name}") for n, name in enumerate(WORKDAYS, start=1)]
    )
    return rows.selectExpr(
        *BLOCK_KEYS,
        "piece",
        "pos",
        "'items' AS kind",
        *[f"{name}.{part} AS {name}{suffix}" for name in WORKDAYS for part, suffix in CELL_PARTS],
    )


def day_rows(day_grid: DataFrame) -> DataFrame:
    """The day-number row that heads each week, in the columns of grid rows."""
    nothing = F.lit(None).cast("string")
    return day_grid.select(
        *BLOCK_KEYS,
        F.lit("days").alias("kind"),
        *[
            value.alias(f"{name}{suffix}")
            for name in WORKDAYS
            for value, (_, suffix) in zip((F.col(name), nothing, nothing, F.lit(1)), CELL_PARTS)
        ],
    )


def numbered_in_pieces(rows: DataFrame) -> DataFrame:
    """Adds ``place``, the number of a row within its piece; rows lie together by piece already."""
    place = F.row_number().over(W.partitionBy(*BLOCK_KEYS, "piece").orderBy("pos"))
    return rows.withColumn("place", place)


def grid_rows(heads: DataFrame, placed: DataFrame) -> DataFrame:
    """Day-number rows and item rows with ``grid_row``, the number of a row within its month.

    Rows that lost all their cells are gone. A row's number is that of its piece's first row and
    its place in the piece: ``placed`` rows are read twice, once for the sizes of pieces.
    """
    heading = F.lit(-1).cast("long").alias("piece"), F.lit(1).alias("n")
    counts = (
        placed.groupBy(*BLOCK_KEYS, "piece")
        .agg(F.max("place").alias("n"))
        .unionByName(heads.select(*BLOCK_KEYS, *heading))
    )
    month = W.partitionBy("calendar_id", "year", "month").orderBy("week", "piece")
    above = F.coalesce(F.sum("n").over(month.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*BLOCK_KEYS, "piece", above.alias("above"))
    body = (
        placed.join(starts, [*BLOCK_KEYS, "piece"])
        .withColumn("grid_row", (F.col("above") + F.col("place")).cast("int"))
        .drop("piece", "pos", "place", "above")
    )
    tops = heads.join(starts.where("piece = -1"), [*BLOCK_KEYS]).withColumn(
        "grid_row", (F.col("above") + 1).cast("int")
    )
    return body.unionByName(tops.select(*body.columns))

"""The whole calculation, from sessions and dimensions to grid rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import rows_of_year
from daygrid.functions.text import Abbreviation, starts_with_digit
from daygrid.operators import layout, months, slots, weekrows, wording
from daygrid.operators.items import calendar_items
from daygrid.plans.staging import drop_staged, stage
from daygrid.sources.dimensions import Rule, special_days


class Calendar:
    """Calendar tables of all calendars and years in the input.

    The items are staged once, because banners and timed items are read apart. So are
    the week rows of the banners and the numbered timed items; a property that builds on one
    of these writes it first, `prepare` writes all of them, the last two at once. `close`, or leaving a
    ``with`` block, deletes what this calendar staged.
    """

    _STAGED = ("items", "week_rows", "timed")

    def __init__(
        self,
        sessions: DataFrame,
        officers: DataFrame,
        rules: Sequence[Rule],
        specials: DataFrame,
        abbreviations: Sequence[Abbreviation] = (),
        palette: Mapping[str, str] | None = None,
        year: int | None = None,
        presiding: DataFrame | None = None,
        templates: Mapping[str, str] = months.TITLE_TEMPLATES,
    ):
        self.sessions = rows_of_year(sessions, year)
        self.officers = officers
        self.rules = rules
        self.special_days = special_days(specials, year)
        self.abbreviations = abbreviations
        self.palette = palette or {"Black": "FF000000"}
        self.presiding = presiding
        self.templates = templates
        self._paths: list[str] = []

    def _stage(self, frame: DataFrame, label: str) -> DataFrame:
        return stage(frame, label, self._paths)

    def prepare(self) -> Calendar:
        """Runs the jobs that the results build on."""
        missing = [name for name in self._STAGED[1:] if name not in self.__dict__]
        if missing:
            _ = self.items  # written first, since both others read them
            with ThreadPoolExecutor(len(missing)) as pool:
                list(pool.map(self.__getattribute__, missing))
        return self

    def close(self) -> None:
        """Deletes the staged tables; call it once the results are written."""
        for name in self._STAGED:
            self.__dict__.pop(name, None)
        drop_staged(self.sessions.sparkSession, self._paths)

    def __enter__(self) -> Calendar:
        return self.prepare()

    def __exit__(self, *error) -> None:
        self.close()

    @property
    def unstaged_items(self) -> DataFrame:
        return calendar_items(self.sessions, self.officers, self.rules, self.special_days)

    @cached_property
    def items(self) -> DataFrame:
        return self._stage(self.unstaged_items, "items")

    @property
    def dated(self) -> DataFrame:
        """All dates before joins and duplicates: enough for years and spine bounds."""
        keys = ["calendar_id", "session_date"]
        return self.sessions.select(*keys).unionByName(self.special_days.select(*keys))

    @property
    def years(self) -> DataFrame:
        return months.calendar_years(self.dated)

    @property
    def month_titles(self) -> DataFrame:
        """Sheet name, title and subtitle of each month; needs the presiding officers."""
        if self.presiding is None:
            raise ValueError("month titles need the presiding officers")
        return months.month_titles(self.years, self.presiding, self.templates)

    @property
    def unstaged_week_slots(self) -> DataFrame:
        return slots.week_slots(self.items)

    @cached_property
    def week_rows(self) -> DataFrame:
        """Every slot of a week with its five days: see `weekrows.week_rows`."""
        return self._stage(weekrows.week_rows(self.items, self.palette), "weeks")

    @property
    def week_slots(self) -> DataFrame:
        return self.week_rows.drop("rows_0", "rows_1", "days")

    @cached_property
    def timed(self) -> DataFrame:
        """Timed items of workdays with their place in the day."""
        timed = layout.on_workdays(slots.timed_items(self.items))
        parts = int(timed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cuts = layout.timed_cuts(timed, parts)
        held = None if cuts is None else self._stage(cuts, "cuts")
        return self._stage(layout.timed_positions(timed, held), "timed")

    @property
    def spine_bounds(self) -> DataFrame:
        return slots.spine_bounds(self.dated)

    @property
    def date_spine(self) -> DataFrame:
        return slots.date_spine(self.spine_bounds)

    @property
    def slot_aligned(self) -> DataFrame:
        return slots.slot_aligned(weekrows.aligned_days(self.week_rows, self.spine_bounds))

    @property
    def slotted(self) -> DataFrame:
        return slots.slotted(self.slot_aligned, self.items)

    @property
    def day_positions(self) -> DataFrame:
        self.prepare()
        return layout.day_positions(self.slot_aligned, self.timed, weekrows.week_sizes(self.week_rows))

    @property
    def calendar_positions(self) -> DataFrame:
        """`day_positions` on every workday of the calendar years, empty ones included."""
        return layout.on_calendar(
            months.workdays_of(self.years),
            self.day_positions,
            slots.days_with_rows(self.week_rows, self.timed, self.date_spine),
        )

    def worded(self, placed: DataFrame) -> DataFrame:
        """Adds the abbreviated and colour-tagged text to rows whose order is settled."""
        short = wording.abbreviate_timed(placed, self.abbreviations)
        return wording.with_tag(wording.with_argb(short, self.palette))

    @property
    def item_grid(self) -> DataFrame:
        """Tagged texts by week, position and weekday, blank slot rows included."""
        self.prepare()
        banners = weekrows.banner_grid(self.week_rows, self.spine_bounds)
        timed = layout.item_grid(self._placed_timed("slots"))
        return banners.select(*timed.columns).unionByName(timed)

    def _placed_timed(self, *sizes: str) -> DataFrame:
        """Timed cells after the rows of the week that ``sizes`` counts, with their place among
        the timed items of the day. No such text is blank: it holds the brackets of its officer."""
        placed = self.worded(self.timed).join(
            weekrows.week_sizes(self.week_rows), [*slots.WEEK_KEYS], "left"
        )
        side = weekrows.SIDE.format(day="session_date", friday="date_add(session_date, 5 - dow)")
        rows = "slots" if sizes else f"if({side} = 0, rows_0, rows_1)"
        return placed.selectExpr(
            *layout.BLOCK_KEYS,
            "session_date",
            "dow",
            f"coalesce({rows}, 0) + timed_pos AS pos",
            "tagged",
            "coalesce(lasts[dow - 1], 0) + timed_pos AS risen_pos",
        )

    @property
    def timed_cells(self) -> DataFrame:
        """Timed cells after the last banner row of the week that shows something. ``risen_pos``
        is their place if they follow the last banner of their day."""
        return self._placed_timed()

    @property
    def loose_cells(self) -> DataFrame:
        """Timed cells that may merge, with their runs: those without a readable time, whose texts
        don't start with a digit."""
        return layout.mark_spans(self.timed_cells.where(~starts_with_digit(F.col("tagged"))))

    @property
    def span_runs(self) -> DataFrame:
        self.prepare()
        runs = layout.span_runs(weekrows.banner_cells(self.week_rows))
        return runs.unionByName(layout.span_runs(self.loose_cells))

    @property
    def compacted_cells(self) -> DataFrame:
        """Cells with their position before and after they move up; cells that vanish are gone.

        Timed cells fill their day without gaps. So they follow its last banner, merged or
        moved, down to the first merged one among them; that one and all below it stay.
        """
        self.prepare()
        nowhere = F.lit(None).cast("int")
        loose = self.loose_cells
        labelled = self.timed_cells.where(starts_with_digit(F.col("tagged")))
        timed = labelled.withColumns({"span_first": nowhere, "span_days": nowhere}).unionByName(loose)
        keys = [*layout.DAY_KEYS]
        walls = (
            loose.where(F.col("span_days").isNotNull()).groupBy(*keys).agg(F.min("pos").alias("wall"))
        )
        stays = F.coalesce(F.col("pos") >= F.col("wall"), F.lit(False))
        placed = layout.decode(timed.join(walls, keys, "left")).withColumn(
            "new_pos", F.when(stays, F.col("pos")).otherwise(F.col("risen_pos"))
        )
        banners = weekrows.banner_cells(self.week_rows).where(F.col("new_pos").isNotNull())
        return banners.unionByName(placed.select(*banners.columns))

    @property
    def final_grid(self) -> DataFrame:
        """Day-number rows and item rows of every month, numbered from its top."""
        heads = layout.day_rows(months.month_day_grid(self.years))
        rows = layout.numbered_in_pieces(layout.wide_rows(self.compacted_cells))
        return layout.grid_rows(heads, self._stage(rows, "rows"))

    @property
    def sheets(self) -> DataFrame:
        """`final_grid` with the sheet name, title and subtitle of each row's month."""
        month = ["calendar_id", "year", "month"]
        titles = self.month_titles.select(*month, "sheet_name", "title", "subtitle")
        return self.final_grid.join(titles, month)

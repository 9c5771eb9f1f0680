import datetime as dt
import random

import pytest
from brute import DAYS, grid
from pyspark.sql import functions as F

from daygrid.functions.text import Abbreviation
from daygrid.operators import layout, weekrows
from daygrid.plans.calendar import Calendar
from daygrid.plans.config import calendar_from_config
from daygrid.sinks.tables import write_months
from daygrid.sources import dimensions
from daygrid.sources.dimensions import Rule

PALETTE = {"Black": "FF000000", "Red": "FFFF0000", "Blue": "FF0000FF"}
ABBREVIATIONS = [Abbreviation("Call", "C"), Abbreviation("priority call", "PC")]
RULES = [
    Rule("jury trial", "JURY (${JudicialOfficer}$-$CourtRoom}$)", 0),
    Rule("trial", "TRIAL", 1),
    Rule("bench", None, 2),
]
OFFICERS = [("A", "AAA", "Red", 0), ("B", "BBB", "Blue", 1), ("B2", "BBB", "Red", 2)]
SESSION_SCHEMA = (
    "calendar_id string, session_date date, start_time string, description string, "
    "room_code string, officer_code string"
)
CELL = [f"{day}{suffix}" for day in DAYS for _, suffix in layout.CELL_PARTS]
GRID_COLUMNS = ["calendar_id", "year", "month", "grid_row", "week", "kind", *CELL]


def random_sessions(seed, times, calendars=("X", "Y"), start=dt.date(2025, 1, 27), days=40, n=160):
    rng = random.Random(seed)
    texts = ["(AAA) Jury Trial", "Bench call", "trial", "Priority Call", "(BBB) x-[y] z", "-[q]", None]
    return [
        (
            rng.choice(calendars),
            start + dt.timedelta(rng.randrange(days)),
            rng.choice(times),
            rng.choice(texts),
            rng.choice(["1", "2", None]),
            rng.choice(["AAA", "BBB", "CCC", None]),
        )
        for _ in range(n)
    ]


def random_specials(seed, start=dt.date(2025, 1, 27), days=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        first = start + dt.timedelta(rng.randrange(days))
        name = rng.choice(["BREAK", "FAIR", "4TH DAY", "", "-[TAG]", "Empty"])
        rows.append(
            (
                rng.choice(["X", "Y"]),
                name,
                None,
                first,
                first + dt.timedelta(rng.randrange(-2, 9)),
                rng.choice(["Red", "Blue", None, ""]),
                rng.choice([0, 2, 3, None]),
            )
        )
    return rows


def calendar_of(spark, sessions, specials, **options):
    return Calendar(
        spark.createDataFrame(sessions, SESSION_SCHEMA),
        dimensions.officers(spark, OFFICERS),
        RULES,
        dimensions.specials(spark, specials),
        ABBREVIATIONS,
        PALETTE,
        **options,
    )


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*GRID_COLUMNS).collect()), key=str)


GOOD_TIMES = ["08:30", "09:00", "13:05", "00:15"]
ODD_TIMES = [None, "", "ALL DAY", "9:5", "09:00"]


@pytest.mark.parametrize(
    "seed,times",
    [(1, GOOD_TIMES), (2, GOOD_TIMES), (3, ODD_TIMES), (4, ODD_TIMES), (5, ["ALL DAY"]),
     (6, [*GOOD_TIMES, "0 AM", "ALL DAY"]), (7, ["0 AM", "09:00"])],
)
def test_grid_equals_sequential_model(spark, monkeypatch, seed, times):
    monkeypatch.setattr("daygrid.operators.ranking.BLOCK_ROWS", 3)
    calendar = calendar_of(spark, random_sessions(seed, times), random_specials(seed))
    items = [r.asDict() for r in calendar.items.collect()]
    expected = sorted(grid(items, [(a.phrase, a.abbrev) for a in ABBREVIATIONS], PALETTE), key=str)
    assert rows_of(calendar.final_grid) == expected


def test_a_crowded_time_is_divided(spark):
    """Nearly all items have one day, order and time, so that cut points number them."""
    sessions = random_sessions(9, ["0 AM"], calendars=("X",), days=2, n=90)
    calendar = calendar_of(spark, sessions, random_specials(9))
    items = [r.asDict() for r in calendar.items.collect()]
    expected = sorted(grid(items, [(a.phrase, a.abbrev) for a in ABBREVIATIONS], PALETTE), key=str)
    assert rows_of(calendar.final_grid) == expected
    assert layout.timed_cuts(calendar.timed.drop("timed_pos"), 8) is not None


def test_several_years_are_like_single_years(spark):
    sessions = random_sessions(8, GOOD_TIMES, start=dt.date(2023, 12, 20))
    specials = random_specials(8, start=dt.date(2023, 12, 20))
    both = calendar_of(spark, sessions, specials).final_grid
    for year in (2023, 2024):
        single = calendar_of(spark, sessions, specials, year=year).final_grid
        assert rows_of(both.where(F.col("year") == year)) == rows_of(single)


def cells_of(spark, rows):
    """rows: {pos: [five tagged texts or None]}"""
    monday = dt.date(2025, 6, 2)
    flat = [
        ("X", 2025, 6, 22, monday + dt.timedelta(i), i + 1, pos, text)
        for pos, texts in rows.items()
        for i, text in enumerate(texts)
        if text
    ]
    schema = (
        "calendar_id string, year int, month int, week int, session_date date, dow int, "
        "pos int, tagged string"
    )
    return spark.createDataFrame(flat, schema)


def test_runs(spark):
    a, b, red, blue = "A-[1]", "B-[1]", "T-[FFFF0000]", "T-[FF0000FF]"
    cells = cells_of(
        spark,
        {
            1: [a, a, None, a, a],
            2: [a, a, b, b, b],
            3: [red, blue, red, blue, red],
            4: ["9:00 x"] * 5,
            5: [a] * 5,
            6: [a, b, a, b, "Empty"],
        },
    )
    runs = layout.span_runs(layout.mark_spans(cells))
    found = sorted((r.pos, r.first_dow, r.last_dow, r.n_days) for r in runs.collect())
    assert found == [(1, 1, 2, 2), (1, 4, 5, 2), (2, 1, 2, 2), (2, 3, 5, 3), (5, 1, 5, 5)]


def banner_items(spark, rows):
    """rows: [(order, text, days of the week of 30 June 2025 that show it)]"""
    monday = dt.date(2025, 6, 30)
    flat = [
        ("X", monday + dt.timedelta(day - 1), "", text, None, "", order, 2025, 26)
        for order, text, days in rows
        for day in days
    ]
    schema = (
        "calendar_id string, session_date date, start_time string, description string, color string, "
        "officer_code string, display_order int, year int, week int"
    )
    return spark.createDataFrame(flat, schema)


@pytest.mark.parametrize("shared_order", [False, True])
def test_cells_do_not_move_past_a_merged_cell(spark, shared_order):
    """Rows of one order are one piece of the pass over a week, rows of many are several."""
    rows = [("a", [3]), ("b", [2]), ("c", [2, 3]), ("d", [4]), ("e", [2]), ("f", [3, 5]), ("g", [6])]
    rows = [(1 if shared_order else n, text, days) for n, (text, days) in enumerate(rows)]
    made = weekrows.week_rows(banner_items(spark, rows), PALETTE)
    cells = weekrows.banner_cells(made).collect()
    # Monday is in June; Saturday's banner has a slot and no cell.
    assert sorted((r.text, r.dow, r.month, r.pos, r.new_pos, r.span_days) for r in cells) == [
        ("a", 3, 7, 1, 1, None),
        ("b", 2, 7, 2, 1, None),
        ("c", 2, 7, 3, 3, 2),
        ("c", 3, 7, 3, 3, 2),
        ("d", 4, 7, 4, 1, None),
        ("e", 2, 7, 5, 4, None),
        ("f", 3, 7, 6, 4, None),
        ("f", 5, 7, 6, 1, None),
    ]
    assert sorted((r.slot_pos, r.row_num, r.description) for r in made.collect()) == [
        (n, n, text) for n, text in enumerate("abcdefg", start=1)
    ]


def test_runs_end_where_the_month_does(spark):
    rows = [(1, "June only", [1]), (2, "both", [1, 2, 3]), (3, "July", [2, 3])]
    made = weekrows.week_rows(banner_items(spark, rows), PALETTE)
    cells = weekrows.banner_cells(made).collect()
    assert sorted((r.text, r.dow, r.month, r.pos, r.new_pos, r.span_first, r.span_days) for r in cells) == [
        ("July", 2, 7, 2, 2, 2, 2),
        ("July", 3, 7, 2, 2, 2, 2),
        ("June only", 1, 6, 1, 1, None, None),
        ("both", 1, 6, 2, 2, None, None),
        ("both", 2, 7, 1, 1, 2, 2),
        ("both", 3, 7, 1, 1, 2, 2),
    ]


def exchanges(frame):
    """Exchanges and windows of the plan, those of broadcasts left out."""
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    executed = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return executed.count(" Exchange "), plan.count("Window ")


def test_plans_over_week_rows_are_short(spark):
    with calendar_of(spark, random_sessions(1, GOOD_TIMES), random_specials(1)) as calendar:
        shuffles, windows = exchanges(calendar.span_runs)
        assert windows == 0 and shuffles <= 2
        shuffles, windows = exchanges(weekrows.banner_cells(calendar.week_rows))
        assert (shuffles, windows) == (0, 0)
        shuffles, windows = exchanges(calendar.slot_aligned)
        assert windows == 0 and shuffles == 1
        assert exchanges(calendar.compacted_cells)[1] == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_compaction_keeps_cells_and_order(spark, seed):
    calendar = calendar_of(spark, random_sessions(seed, ODD_TIMES), random_specials(seed))
    rows = calendar.compacted_cells.collect()
    columns = {}
    for row in rows:
        columns.setdefault((row.calendar_id, row.session_date), []).append(row)
    for column in columns.values():
        before = [r.tagged for r in sorted(column, key=lambda r: r.pos)]
        after = [r.tagged for r in sorted(column, key=lambda r: r.new_pos)]
        assert before == after
        assert len({r.new_pos for r in column}) == len(column)
        assert all(r.new_pos <= r.pos for r in column)


def test_spans_do_not_overlap(spark):
    calendar = calendar_of(spark, random_sessions(13, ODD_TIMES), random_specials(13))
    taken = set()
    for run in calendar.span_runs.collect():
        for dow in range(run.first_dow, run.last_dow + 1):
            cell = (run.calendar_id, run.year, run.month, run.week, run.pos, dow)
            assert cell not in taken
            taken.add(cell)
    assert taken


def test_unknown_color_fails_the_job(spark):
    calendar = calendar_of(spark, random_sessions(1, GOOD_TIMES), random_specials(1))
    calendar.palette = {"Black": "FF000000"}
    with pytest.raises(Exception, match="unknown colour"):
        calendar.final_grid.collect()


def test_calendar_from_a_document_is_written_by_month(spark, tmp_path):
    document = {
        "calendar_year": 2025,
        "officers": [{"name": "A", "officer_code": "AAA", "color": "Red", "seq": 0}],
        "rules": [{"pattern_name": "jury", "template": "JURY", "display_order": 0}],
        "specials": [
            {"calendar_id": "X", "name": "BREAK", "begin_date": "2024-12-30",
             "end_date": "2025-01-02", "display_order": 2}
        ],
        "abbreviations": [{"phrase": "call", "abbrev": "C"}, {"phrase": "\\.", "abbrev": None, "skip": True}],
        "colors": [{"color_name": n, "argb": a} for n, a in PALETTE.items()],
        "presiding": [{"name": n, "officer_code": n, "color": "Red", "seq": i} for n, i in (("P", 2), ("Q", 7))],
        "titles": {"title": "${calendar_month_name}$ of ${calendar_year}$"},
    }
    rows = [("X", dt.date(2025, 1, 7), "09:00", "(AAA) Call", "1", "AAA"),
            ("X", dt.date(2024, 1, 7), "09:00", "(AAA) Call", "1", "AAA")]
    calendar = calendar_from_config(spark.createDataFrame(rows, SESSION_SCHEMA), document, year=2024)
    path = str(tmp_path / "grid")
    write_months(calendar.final_grid, path)
    back = spark.read.parquet(path)
    assert back.select("year").distinct().collect()[0].year == 2025
    assert back.select("month").distinct().count() == 12
    january = back.where("month = 1 AND kind = 'items'").orderBy("grid_row").collect()
    assert [(r.wed, r.wed_span, r.thu, r.tue, r.tue_role) for r in january] == [
        ("BREAK", 2, None, None, None), (None, None, None, "9:00 C (A)", "timed")
    ]
    titles = calendar.month_titles.orderBy("month").collect()
    assert [(r.title, r.presiding) for r in titles[:3]] == [
        ("January of 2025", "P"), ("February of 2025", "Q"), ("March of 2025", "P")
    ]
    assert titles[0].subtitle == "Presiding: P" and len(titles) == 12
    assert calendar.officers.count() == 3


def test_closing_deletes_what_a_calendar_staged(spark, tmp_path, monkeypatch):
    scratch = tmp_path / "shared"
    monkeypatch.setattr("daygrid.plans.staging.scratch_dir", lambda _: str(scratch))
    other = calendar_of(spark, random_sessions(2, GOOD_TIMES), random_specials(2)).prepare()
    with calendar_of(spark, random_sessions(1, GOOD_TIMES), random_specials(1)) as calendar:
        first = rows_of(calendar.final_grid)
    assert len(list((scratch / "daygrid").iterdir())) == 3
    assert other.items.count() and rows_of(calendar.final_grid) == first
    other.close()
    calendar.close()
    assert not list((scratch / "daygrid").iterdir())

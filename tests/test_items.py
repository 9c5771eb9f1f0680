import datetime as dt
import random
import re

from pyspark.sql import functions as F

from daygrid.operators import checks, items, rulematch, slots, weekrows, wording
from daygrid.sources import dimensions
from daygrid.sources.dimensions import Rule

DAY = dt.date(2025, 1, 6)
SESSION_SCHEMA = (
    "calendar_id string, session_date date, start_time string, description string, "
    "room_code string, officer_code string"
)
ITEM_SCHEMA = (
    "calendar_id string, session_date date, start_time string, description string, "
    "color string, officer_code string, display_order int"
)


def sessions(spark, *rows):
    return spark.createDataFrame([("X", DAY, *row) for row in rows], SESSION_SCHEMA)


def items_of(spark, *rows):
    return items.with_week(spark.createDataFrame([("X", *row) for row in rows], ITEM_SCHEMA))


def test_officer_join_keeps_and_fans_out(spark):
    officers = dimensions.officers(
        spark, [("a", "A", "Red", 0), ("b", "A", "Blue", 1), ("c", None, "Green", 2)]
    )
    rows = sessions(spark, ("09:00", "d", "1", "A"), ("09:00", "d", "1", "Z"), ("09:00", "d", "1", None))
    joined = items.with_officers(rows, officers).select("officer_code", "color").collect()
    assert sorted(map(tuple, joined), key=str) == [("A", "Blue"), ("A", "Red"), ("Z", None), (None, None)]


RULES = [Rule("jury", "J ${JudicialOfficer}$ $CourtRoom}$", 0), Rule("jury trial", "T", None),
         Rule("open", None, 7)]


def test_both_ways_of_matching_agree(spark):
    rows = sessions(spark, ("09:00", "Jury Trial", "1", "A"), ("09:00", "jury", "1", "A"),
                    ("09:00", "other", "1", "A"), ("09:00", None, "1", "A"), ("08:00", "other", "1", "A"))
    direct = items.match_rules(rows, RULES)
    distinct = rulematch.match_rule_table(rows, dimensions.rules(spark, RULES))
    assert direct.exceptAll(distinct).count() == 0 and distinct.exceptAll(direct).count() == 0
    assert direct.count() == 6
    assert items.match_rules(rows, []).where(F.col("template").isNull()).count() == 5


def test_long_rule_tables(spark):
    """20,000 rules: overlapping, repeated, of one letter, of none, with wildcards of their own."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    names = [" ".join(word() for _ in range(rng.randint(2, 4))) for _ in range(20_000)]
    names += ["", None, "a", "É", "a_c", "b%d", "- -", "c\\d", "ab", "ab"]
    rules = [Rule(name, f"T{k}", k % 9) for k, name in enumerate(names)]
    texts = [" ".join(word().upper() for _ in range(rng.randint(0, 5))) for _ in range(150)]
    texts += [None, "", "xa_c", "xabc", "b-d", "c\\d", "É"]
    rows = sessions(spark, *[("09:00", text, "1", "A") for text in texts * 2])

    def pattern(name):
        words = (name or "").replace("-", "").replace(" ", "%").lower()
        return re.compile(".*" + "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in words) + ".*", re.S)

    patterns = [pattern(name) for name in names]
    expected = []
    for text in texts * 2:
        hits = [k for k, p in enumerate(patterns) if text is not None and p.fullmatch(text.lower())]
        expected += [(text, f"T{k}", k % 9) for k in hits] or [(text, None, None)]
    found = rulematch.match_rule_table(rows, dimensions.rules(spark, rules))
    got = found.select("description", "template", "rule_order").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_labels(spark):
    officers = dimensions.officers(spark, [("a", "A", "Red", 0)])
    rows = sessions(
        spark,
        ("13:30", "(ABC) Jury Trial", "1", "A"),
        ("13:30", "jury", None, "A"),
        ("13:30", "(ABC) Open", "1", "ZY"),
        (None, "(ABC) plain", "1", None),
    )
    days = dimensions.special_days(dimensions.specials(spark, []))
    found = items.calendar_items(rows, officers, RULES, days)
    cut = found.select("start_time", "description", "color", "display_order", "week", "year")
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(
        [
            ("", "J A 1", "Red", 0, 1, 2025),
            ("", "T", "Red", 3, 1, 2025),
            ("", None, "Red", 0, 1, 2025),
            ("13:30", "1:30 Open (Y)", None, 7, 1, 2025),
            (None, "plain ()", None, 3, 1, 2025),
        ],
        key=str,
    )


def test_equal_items_collapse(spark):
    officers = dimensions.officers(spark, [])
    rows = sessions(spark, ("09:00", "d", "1", "A"), ("09:00", "d", "2", "A"))
    entry = ("X", "D", DAY, None, None, None, 2)
    days = dimensions.special_days(dimensions.specials(spark, [entry, entry]))
    assert items.calendar_items(rows, officers, RULES, days).count() == 2


def test_special_days(spark):
    d = dt.date
    entries = dimensions.specials(
        spark,
        [
            ("X", "range", None, d(2025, 1, 30), d(2025, 2, 1), None, 2),
            ("X", "date", d(2025, 1, 1), d(2025, 1, 5), d(2025, 1, 9), None, 2),
            ("X", "backwards", None, d(2025, 1, 2), d(2025, 1, 1), None, 2),
            ("X", "open", None, d(2025, 3, 1), None, None, 2),
        ],
    )
    rows = dimensions.special_days(entries).select("name", "session_date").collect()
    assert sorted(map(tuple, rows)) == [
        ("date", d(2025, 1, 1)),
        ("open", d(2025, 3, 1)),
        ("range", d(2025, 1, 30)),
        ("range", d(2025, 1, 31)),
        ("range", d(2025, 2, 1)),
    ]


def test_abbreviation_only_for_items_with_a_time(spark):
    from daygrid.functions.text import Abbreviation

    rows = items_of(
        spark,
        (DAY, "09:00", "call", None, "A", 3),
        (DAY, "", "call", None, "A", 3),
        (DAY, None, "call", None, "A", 3),
    )
    done = wording.abbreviate_timed(rows, [Abbreviation("CALL", "C")])
    assert {(r.start_time, r.description) for r in done.collect()} == {
        ("09:00", "C"), ("", "call"), (None, "call")
    }


def test_slots_number_weeks_through_the_year(spark):
    d = dt.date
    rows = items_of(
        spark,
        (d(2025, 1, 6), "", "b", None, "", 2),
        (d(2025, 1, 7), "", "b", None, "", 2),
        (d(2025, 1, 7), "", "b", None, "", 3),
        (d(2025, 1, 8), "", None, None, "", 2),
        (d(2025, 1, 8), "09:00", "timed", None, "", 2),
        (d(2025, 1, 14), "", "a", None, "", None),
        (d(2025, 1, 14), "", "c", None, "", 9),
        (d(2026, 1, 6), "", "z", None, "", 9),
    )
    found = slots.week_slots(rows).collect()
    assert sorted((r.year, r.row_num, r.week, r.display_order, r.description, r.slot_pos) for r in found) == [
        (2025, 1, 1, 2, "b", 1),
        (2025, 2, 1, 2, None, 2),
        (2025, 3, 1, 3, "b", 3),
        (2025, 4, 2, 9, "c", 1),
        (2025, 5, 2, None, "a", 2),
        (2026, 1, 1, 9, "z", 1),
    ]


def test_alignment(spark):
    d = dt.date
    rows = items_of(
        spark,
        (d(2025, 1, 3), "", "b", "Blue", "", 3),
        (d(2025, 1, 3), "", "b", "Red", "", 2),
        (d(2025, 1, 6), "", None, "Red", "B", 2),
        (d(2025, 1, 7), "", "a", None, "", 1),
        (d(2025, 1, 11), "", "sat", None, "", 1),
        (d(2025, 1, 8), "10:00", "t", None, "A", 3),
        (d(2025, 1, 8), None, "n", None, "A", 3),
    )
    palette = {name: name for name in ("Black", "Blue", "Red")}
    days = weekrows.aligned_days(weekrows.week_rows(rows, palette), slots.spine_bounds(rows))
    aligned = slots.slot_aligned(days)
    found = [(r.session_date.day, r.row_num, r.description, r.color, r.display_order) for r in aligned.collect()]
    expected = [(3, 1, "b", "Red", 2), (3, 2, "b", "Red", 2)]
    for day in range(6, 11):
        expected += [
            (day, 3, "a", None, 1) if day == 7 else (day, 3, "", "", 999),
            (day, 4, "", "", 999),
            (day, 5, None, "Red", 2) if day == 6 else (day, 5, "", "", 999),
        ]
    assert sorted(found, key=str) == sorted(expected, key=str)
    everything = slots.slotted(aligned, rows).collect()
    assert {(r.description, r.row_num) for r in everything if r.kind == 1} == {("t", 9999), ("n", 9999)}


def test_unknown_colors(spark):
    rows = items_of(
        spark,
        (DAY, "", "a", "Red", "", 1),
        (DAY, "", "b", "Mauve", "", 1),
        (DAY, "", "c", "Mauve", "", 1),
        (DAY, "", "d", None, "", 1),
        (DAY, "", "e", "", "", 1),
    )
    found = checks.unknown_colors(rows, {"Red": "1", "Black": "2"}).collect()
    assert [tuple(r) for r in found] == [("Mauve", 2)]
    known = wording.with_argb(rows, {"Red": "1", "Black": "2", "Mauve": "3"}).collect()
    assert {(r.description, r.argb) for r in known} == {
        ("a", "1"), ("b", "3"), ("c", "3"), ("d", "2"), ("e", "2")
    }

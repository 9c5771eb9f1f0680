import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from daygrid.functions import dates, labels, text
from daygrid.functions.text import Abbreviation


def values(spark, column, inputs, kind="string"):
    frame = spark.createDataFrame(list(enumerate(inputs)), f"n int, v {kind}")
    rows = frame.select("n", column(F.col("v")).alias("r")).orderBy("n").collect()
    return [row.r for row in rows]


def test_time_label(spark):
    cases = {
        "09:05": "9:05 ",
        "9:05": "9:05 ",
        "13:30": "1:30 ",
        "00:15": "12:15 ",
        "12:00": "12:00 ",
        "23:59:59": "11:59 ",
        "24:00": None,
        "": None,
        "noon": None,
        None: None,
    }
    assert values(spark, labels.time_label, cases) == list(cases.values())


def test_code_prefix_goes_once(spark):
    cases = {
        "(JSB) a (PCS) b": "a (PCS) b",
        "x (JSB) a": "x a",
        "(JSB-VJ) a": "(JSB-VJ) a",
        "(jsb) a": "(jsb) a",
        "line\n(ABC) b": "line\nb",
        "": "",
        None: None,
    }
    assert values(spark, labels.strip_code_prefix, cases) == list(cases.values())


def test_last_char(spark):
    assert values(spark, labels.last_char, ["AB", "", None]) == ["B", "", None]


def test_template_fill(spark):
    rows = [("R-${JudicialOfficer}$-$CourtRoom}$", "1", "AB"), ("T $CourtRoom}", "1", "AB"),
            ("T", None, "AB"), ("T", "1", None), (None, "1", "AB")]
    frame = spark.createDataFrame(rows, "t string, room string, officer string")
    filled = frame.select(labels.fill_template(F.col("t"), F.col("room"), F.col("officer")))
    assert [r[0] for r in filled.collect()] == ["R-AB-1", "T $CourtRoom}", None, None, None]


@pytest.mark.parametrize(
    "name,description,hit",
    [
        ("SU CV JURY TRIALS", "(X) su cv - Jury Trials", True),
        ("SU CV JURY TRIALS", "(X) SU CV - Jury Trial", False),
        ("pur-chase", "a PURCHASE b", True),
        ("100", "1\n00", False),
        ("a b", "a\nb", True),
        ("a_c", "abc", True),
        ("a\\c", "a\\c", True),
        ("a\\c", "ac", False),
        ("", "x", True),
        (None, "x", True),
        (None, None, None),
    ],
)
def test_rule_match(spark, name, description, hit):
    assert values(spark, lambda c: labels.matches_rule(c, name), [description]) == [hit]


def test_sunday_weeks(spark):
    days = [dt.date(1999, 1, 1) + dt.timedelta(n) for n in range(11000)]
    assert values(spark, dates.sunday_week, days, "date") == [int(d.strftime("%U")) for d in days]


def test_weekday_and_month_parts(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(n) for n in range(1500)]
    assert values(spark, dates.iso_weekday, days, "date") == [d.isoweekday() for d in days]
    assert values(spark, dates.month_name, days, "date") == [d.strftime("%B") for d in days]
    assert values(spark, dates.is_workday, days, "date") == [d.isoweekday() < 6 for d in days]
    work = [d for d in days if d.isoweekday() < 6]
    blocks, seen = [], {}
    for day in work:
        weeks = seen.setdefault((day.year, day.month), [])
        if day.strftime("%U") not in weeks:
            weeks.append(day.strftime("%U"))
        blocks.append(weeks.index(day.strftime("%U")) + 1)
    assert values(spark, dates.month_week, work, "date") == blocks


def abbreviated(spark, pairs, inputs):
    entries = [Abbreviation(*pair) for pair in pairs]
    return values(spark, lambda c: text.abbreviate(c, entries), inputs)


def test_abbreviations_apply_in_order(spark):
    pairs = [("calendar call", "CC"), ("Priority Calendar Call", "PCC"), ("cc x", "Y")]
    assert abbreviated(spark, pairs, ["Priority Calendar Call", "CALENDAR CALL x", None, ""]) == [
        "Priority CC", "Y", None, ""
    ]


def test_abbreviations_are_literal(spark):
    pairs = [("a.c", "$1\\"), ("x\\Ey", "Q"), ("(", "["), ("Ärger", "AE")]
    assert abbreviated(spark, pairs, ["abc A.C a.c", "x\\eY", "(1)", "ÄRGER ärger"]) == [
        "abc $1\\ $1\\", "Q", "(1)", "AE AE"
    ]


def test_abbreviations_of_letters_that_fold_together(spark):
    pairs = [("sign", "$1"), ("Kis", "k"), ("that", "T"), ("\u00c5ng", "A"), ("\u03c3a", "S")]
    texts = ["\u017fign", "sign \u017fign SIGN", "x\n\u017fign\ny Sign", "\u212aIS", "kis \u212ai\u017f", "sigsign",
             "\u212bNG \u00e5ng", "THAT that", "\u03c2a \u03a3A \u03c3a", "\u03c2a", "s" * 5000 + "ign", "", None]

    def model(text):
        for phrase, abbrev in pairs:
            if text and phrase.lower() in text.lower():
                text = re.sub(re.escape(phrase), lambda _: abbrev, text, flags=re.IGNORECASE)
        return text

    assert abbreviated(spark, pairs, texts) == [model(t) for t in texts]


def test_abbreviation_without_replacement():
    with pytest.raises(ValueError):
        text.active_abbreviations([Abbreviation("ab", None)])
    assert text.active_abbreviations([Abbreviation("ab", None, skip=True)]) == []
    assert text.active_abbreviations([Abbreviation(".", None)]) == []


def test_tags(spark):
    tagged = ["A-[FF]", "9 A-[FF]", "A-[x]-[FF]", "A-[]", "plain", "", None]
    assert values(spark, text.tag_argb, tagged) == ["FF", "FF", "x", None, None, None, None]
    assert values(spark, text.untag, tagged) == ["A", "9 A", "A", "A-[]", "plain", "", None]
    assert values(spark, text.cell_role, tagged) == [
        "banner", "timed", "banner", None, None, None, None
    ]
    assert values(spark, lambda c: text.tag(c, F.lit("FF")), ["A", "", None]) == ["A-[FF]", "", None]

"""Counts over an invented month of sessions, worked out by hand from its weekly pattern.

October 2024: hearings on Mondays (banners), reviews on Tuesdays, panels on Wednesdays that
match two rules, calls of an unknown officer on Thursdays, calls without a time on Fridays.
"""

import datetime as dt
import json
import pathlib

import pytest
from brute import grid
from pyspark.sql import functions as F
from test_layout import rows_of

from daygrid.operators import items, layout, slots
from daygrid.plans.config import calendar_from_config
from daygrid.sources import sessions

FIXTURES = pathlib.Path(__file__).parent / "fixtures"
CONFIG = json.loads((FIXTURES / "sample_config.json").read_text())


@pytest.fixture(scope="module")
def rows(spark):
    read = sessions.read_sessions_csv(spark, str(FIXTURES / "sample_month.csv"), "sample")
    return read.withColumn("room_code", F.lit("1")).cache()


@pytest.fixture(scope="module")
def plan(rows):
    with calendar_from_config(rows, CONFIG) as calendar:
        yield calendar


def test_rows_and_matches(rows, plan):
    assert rows.count() == 23 and rows.distinct().count() == 23
    rule = F.col("template").isNotNull().cast("int")
    matches = items.match_rules(rows, plan.rules).groupBy(*rows.columns).agg(F.sum(rule).alias("n"))
    assert {r.n: r["count"] for r in matches.groupBy("n").count().collect()} == {0: 14, 1: 4, 2: 5}
    joined = items.with_officers(rows, plan.officers)
    assert joined.where("color IS NULL").count() == 5


def test_items(plan):
    days = plan.special_days
    assert days.count() == 7
    assert days.distinct().count() == 6
    assert layout.on_workdays(days.distinct()).count() == 4
    timed = slots.timed_items(plan.items).count()
    assert timed == 14
    assert plan.items.count() - 6 - timed == 14


def test_slots_and_alignment(plan):
    assert plan.week_slots.count() == 2 + 4 + 4 + 4 + 3
    spine = plan.date_spine.agg(F.min("session_date"), F.max("session_date"), F.count("*")).first()
    assert tuple(spine) == (dt.date(2024, 10, 1), dt.date(2024, 10, 31), 23)
    aligned = plan.slot_aligned
    assert aligned.count() == 4 * 2 + 5 * 4 + 5 * 4 + 5 * 4 + 4 * 3
    assert aligned.where("display_order <> 999").count() == 4 + 10 + 3 + 1


def test_grid(plan):
    rows = [r.asDict() for r in plan.items.collect()]
    pairs = [(a.phrase, a.abbrev) for a in plan.abbreviations if not a.skip]
    assert rows_of(plan.final_grid) == sorted(grid(rows, pairs, plan.palette), key=str)

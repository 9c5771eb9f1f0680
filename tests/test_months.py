import calendar as cal
import datetime as dt

import pytest

from daygrid.operators import months
from daygrid.sources import dimensions

YEARS = range(2020, 2031)


@pytest.fixture
def years(spark):
    return spark.createDataFrame([("X", y) for y in YEARS], "calendar_id string, year int")


def test_day_grid(years):
    expected = []
    for year in YEARS:
        for month in range(1, 13):
            rows = [r[:5] for r in cal.monthcalendar(year, month) if any(r[:5])]
            for block, row in enumerate(rows, start=1):
                first = dt.date(year, month, next(d for d in row if d))
                week = int(first.strftime("%U"))
                expected.append(("X", year, month, week, block, *[str(d or "Empty") for d in row]))
    assert sorted(map(tuple, months.month_day_grid(years).collect())) == sorted(expected)


def test_workdays(years):
    found = {(r.session_date, r.month, r.dow) for r in months.workdays_of(years).collect()}
    day, expected = dt.date(2020, 1, 1), set()
    while day.year < 2031:
        if day.isoweekday() < 6:
            expected.add((day, day.month, day.isoweekday()))
        day += dt.timedelta(1)
    assert found == expected


def test_titles_take_turns(spark, years):
    presiding = dimensions.officers(spark, [(n, n, None, i) for i, n in enumerate("abc")])
    rows = months.month_titles(years, presiding).where("year = 2024").orderBy("month").collect()
    assert [r.presiding for r in rows] == list("abcabcabcabc")
    assert rows[1].days_in_month == 29
    assert rows[1].sheet_name == "February 2024"
    assert rows[1].title == "February 2024 Master Calendar"
    assert rows[1].subtitle == "Presiding: b"


def test_presiding_list_must_not_be_empty(spark, years):
    with pytest.raises(ValueError):
        months.month_titles(years, dimensions.officers(spark, []))

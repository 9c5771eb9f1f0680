"""A sequential model of the calendar grid, for small inputs."""

from __future__ import annotations

import calendar as cal
import datetime as dt
import re
from itertools import groupby

DAYS = ("mon", "tue", "wed", "thu", "fri")
WIDTH = 5


def nulls_last(values):
    return tuple((v is None, v if v is not None else 0) for v in values)


def week(day):
    return int(day.strftime("%U"))


def day_texts(items, abbreviations, palette):
    """date -> tagged texts from top to bottom, for the items of one calendar year."""
    banners = [i for i in items if i["start_time"] == ""]
    timed = [i for i in items if i["start_time"] != ""]
    slots = sorted(
        {(week(i["session_date"]), i["display_order"], i["description"]) for i in banners},
        key=nulls_last,
    )
    first, last = (f(i["session_date"] for i in items) for f in (min, max))
    texts = {}
    for step in range((last - first).days + 1):
        day = first + dt.timedelta(step)
        if day.isoweekday() > WIDTH:
            continue
        column = []
        for slot_week, _, text in slots:
            if slot_week != week(day):
                continue
            shown = sorted(
                (i for i in banners if i["session_date"] == day and i["description"] == text),
                key=lambda i: nulls_last((i["display_order"], i["color"], i["officer_code"])),
            )
            column.append(tagged(text, shown[0]["color"], palette) if shown else "")
        keys = ("display_order", "start_time", "description", "color", "officer_code")
        for item in sorted(
            (i for i in timed if i["session_date"] == day),
            key=lambda i: nulls_last([i[k] for k in keys]),
        ):
            text = item["description"]
            if item["start_time"]:
                for phrase, short in abbreviations:
                    text = re.sub(re.escape(phrase), lambda _: short, text, flags=re.IGNORECASE)
            column.append(tagged(text, item["color"], palette))
        texts[day] = column
    return texts


def tagged(text, color, palette):
    return f"{text}-[{palette[color or 'Black']}]" if text else ""


class Cell:
    def __init__(self, tagged_text=""):
        self.tagged = tagged_text
        self.span = 1
        self.hidden = False
        found = re.search(r"-\[([^\]]+)\]", tagged_text)
        self.argb = found.group(1) if found else None
        self.text = re.sub(r"-\[.*?\]", "", tagged_text) if found else tagged_text
        self.role = None
        if found:
            self.role = "timed" if tagged_text[0].isdigit() else "banner"

    @property
    def merged(self):
        return self.hidden or self.span > 1


def month_rows(year, month, texts):
    """Rows of one month: (week, kind, [five values]) with values as `grid_values` gives."""
    out = []
    for monday_row in cal.monthcalendar(year, month):
        if not any(monday_row[:WIDTH]):
            continue
        days = [dt.date(year, month, d) if d else None for d in monday_row[:WIDTH]]
        number = week(next(d for d in days if d))
        columns = [texts.get(d, []) if d else [] for d in days]
        height = max(map(len, columns))
        rows = [[c[r] if r < len(c) else "" for c in columns] for r in range(height)]
        rows = [[Cell(t) for t in row] for row in rows if any(row)]
        for row in rows:
            merge(row)
        for dow in range(WIDTH):
            settle([row[dow] for row in rows], lambda r, cell, d=dow, t=rows: t[r].__setitem__(d, cell))
        rows = [row for row in rows if any(c.merged or c.text for c in row)]
        out.append((number, "days", [day_value(d) for d in days]))
        out += [(number, "items", [grid_value(c) for c in row]) for row in rows]
    return out


def merge(row):
    at = 0
    for text, run in groupby(row, key=lambda c: c.tagged):
        length = len(list(run))
        if length > 1 and text and text != "Empty" and not text[0].isdigit():
            row[at].span = length
            for cell in row[at + 1 : at + length]:
                cell.hidden = True
        at += length


def settle(column, put):
    top = 0
    for row, cell in enumerate(column):
        if cell.merged:
            top = row + 1
        elif cell.text:
            if top != row:
                put(row, Cell())
                put(top, cell)
            top += 1


def day_value(day):
    return (str(day.day) if day else "Empty", None, None, 1)


def grid_value(cell):
    if cell.hidden or not (cell.text or cell.span > 1):
        return (None, None, None, None)
    return (cell.text, cell.argb, cell.role, cell.span)


def grid(items, abbreviations, palette):
    """All rows: (calendar, year, month, grid_row, week, kind, mon.., tue.., ...)."""
    result = []
    keys = sorted({(i["calendar_id"], i["session_date"].year) for i in items})
    for calendar_id, year in keys:
        own = [
            i for i in items if i["calendar_id"] == calendar_id and i["session_date"].year == year
        ]
        texts = day_texts(own, abbreviations, palette)
        for month in range(1, 13):
            for n, (number, kind, values) in enumerate(month_rows(year, month, texts), start=1):
                flat = [part for value in values for part in value]
                result.append((calendar_id, year, month, n, number, kind, *flat))
    return result

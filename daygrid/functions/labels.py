"""Text of a calendar item: time label, code prefix, template fill, rule match."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder spellings and the code prefix that the results depend on.
ROOM_PLACEHOLDER = "$CourtRoom}$"
OFFICER_PLACEHOLDER = "${JudicialOfficer}$"
CODE_PREFIX = r"\([A-Z]{3}\) "
CLOCK = "^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"


def time_label(start_time: Column) -> Column:
    """``13:30`` -> ``1:30 `` (12-hour, no AM/PM, trailing blank); null when not a time."""
    hour = F.substring_index(start_time, ":", 1).try_cast("int")
    minute = F.substring(start_time, F.instr(start_time, ":") + 1, F.lit(2))
    label = F.concat(((hour + 11) % 12 + 1).cast("string"), F.lit(":"), minute, F.lit(" "))
    return F.when(start_time.rlike(CLOCK), label)


def strip_code_prefix(description: Column) -> Column:
    """Drops the first three-letter code in brackets; later ones stay."""
    return F.regexp_replace(description, rf"(?s)^(.*?){CODE_PREFIX}", "$1")


def last_char(text: Column) -> Column:
    return F.right(text, F.lit(1))


def timed_label(start_time: Column, description: Column, officer_code: Column) -> Column:
    """Label of a session that no rule maps; null parts are left out."""
    return F.concat_ws(
        "",
        time_label(start_time),
        strip_code_prefix(description),
        F.lit(" ("),
        last_char(officer_code),
        F.lit(")"),
    )


def fill_template(
    template: Column,
    room_code: Column,
    officer_code: Column,
    room_placeholder: str = ROOM_PLACEHOLDER,
    officer_placeholder: str = OFFICER_PLACEHOLDER,
) -> Column:
    """Literal fill, room first; a null room or officer makes the text null."""
    return F.replace(
        F.replace(template, F.lit(room_placeholder), room_code),
        F.lit(officer_placeholder),
        officer_code,
    )


def rule_pattern(pattern_name: str | None) -> str:
    """LIKE pattern of a rule name: no hyphens, blanks match anything, open at both ends.

    A null name gives ``%``, which every non-null description matches. Repeated
    wildcards are one, so that a single word stays a plain substring search.
    """
    return re.sub("%+", "%", "%" + (pattern_name or "").replace("-", "").replace(" ", "%") + "%")


def rule_pattern_of(pattern_name: Column) -> Column:
    """`rule_pattern` for a column of rule names."""
    words = F.regexp_replace(F.coalesce(pattern_name, F.lit("")), "-", "")
    return F.regexp_replace(F.concat(F.lit("%"), F.replace(words, F.lit(" "), F.lit("%")), F.lit("%")), "%+", "%")


def matches_pattern(description: Column, pattern: Column) -> Column:
    """`matches_rule` for a column of LIKE patterns."""
    return F.ilike(description, F.replace(pattern, F.lit("\\"), F.lit("\\\\")))


def matches_rule(description: Column, pattern_name: str | None) -> Column:
    """Case-insensitive LIKE in which the backslash is an ordinary character."""
    return description.ilike(rule_pattern(pattern_name).replace("\\", "\\\\"))

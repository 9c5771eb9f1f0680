"""Phrase abbreviation and the colour tag carried in a cell's text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tag format that cell texts carry until their colour is decoded.
TAG_FIND = r"-\[([^\]]+)\]"
TAG_STRIP = r"-\[.*?\]"


# Letters outside of ASCII that fold to ASCII ones.
ASCII_FOLDS = frozenset("\u0130\u0131\u017f\u212a")


class Abbreviation(NamedTuple):
    phrase: str
    abbrev: str | None
    skip: bool = False


def _is_lone_symbol(phrase: str) -> bool:
    return len(phrase) == 1 and not (phrase.isalpha() or phrase.isdigit() or phrase.isspace())


def active_abbreviations(abbreviations: Sequence[Abbreviation]) -> list[Abbreviation]:
    """The entries that change text, in order.

    Entries of one symbol never fire. An entry without a replacement is an
    error unless it is flagged ``skip``.
    """
    active = []
    for entry in abbreviations:
        if entry.skip or _is_lone_symbol(entry.phrase):
            continue
        if not entry.phrase:
            raise ValueError("abbreviation without a phrase")
        if entry.abbrev is None:
            raise ValueError(f"abbreviation {entry.phrase!r} has no replacement; flag it 'skip'")
        active.append(entry)
    return active


def abbreviate(text: Column, abbreviations: Sequence[Abbreviation]) -> Column:
    """Replaces each phrase, in order and whatever its case; later ones see earlier results.

    A text that doesn't hold the phrase in lower case stays, though letters that merely fold
    together, such as a long s and an s, would match. The steps are a chain of replacements
    with literal patterns: it grows by one step a phrase, and each pattern is compiled once.

    One pass with all phrases as alternatives tells the texts that no step can change. Where
    phrases are ASCII, only texts with one of the few other letters that fold to ASCII need the
    steps that tell these apart; all others take plain ASCII patterns.
    """
    active = active_abbreviations(abbreviations)
    if not active:
        return text
    careful = plain = text
    for entry in active:
        careful = F.regexp_replace(careful, *_step(entry.phrase, entry.abbrev))
        plain = F.regexp_replace(plain, "(?i)" + _java_literal(entry.phrase), _java_replacement(entry.abbrev))
    phrases = "|".join(_java_literal(entry.phrase) for entry in active)
    ascii_only = all(entry.phrase.isascii() for entry in active)
    if not ascii_only or any(ASCII_FOLDS.intersection(entry.abbrev) for entry in active):
        return F.when(text.rlike(f"(?iu){phrases}"), careful).otherwise(text)
    folds = text.rlike("[" + "".join(sorted(ASCII_FOLDS)) + "]")
    return (
        F.when(folds, careful).when(text.rlike(f"(?i){phrases}"), plain).otherwise(text)
    )


@lru_cache(maxsize=1)
def _letter_forms() -> tuple[dict[str, str], set[str]]:
    """Characters by their lower case, and lower cases that others fold to."""
    by_lower: dict[str, str] = {}
    folded = set()
    for code in range(0x110000):
        char = chr(code)
        lower, fold = char.lower(), char.upper().lower()
        if lower != char or fold != char:
            by_lower[lower] = by_lower.get(lower, "") + char
        if fold != lower:
            folded |= {fold, lower}
        if len(lower) > 1:
            folded.add(lower[0])
    return by_lower, folded


def _step(phrase: str, abbrev: str) -> tuple[str, str]:
    """Pattern and replacement for one phrase.

    Where a character of the phrase has forms that fold to it but have another lower case,
    the first match begins at the start of the text and looks ahead for the phrase in lower
    case; each later match goes on from the one before.
    """
    literal, replacement = "(?iu:" + _java_literal(phrase) + ")", _java_replacement(abbrev)
    by_lower, folded = _letter_forms()
    if folded.isdisjoint(phrase.lower()):
        return literal, replacement
    exact = "".join(
        "[" + "".join(re.escape(c) for c in sorted({char, *by_lower.get(char, "")})) + "]"
        for char in phrase.lower()
    )
    return f"(?s)(?:\\A(?=.*{exact})|(?!\\A)\\G)(.*?){literal}", "$1" + replacement


def _java_literal(phrase: str) -> str:
    return "\\Q" + phrase.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _java_replacement(text: str) -> str:
    return re.sub(r"([\\$])", r"\\\1", text)


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def starts_with_digit(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9]"), F.lit(False))


def tag(text: Column, argb: Column) -> Column:
    """``text-[ARGB]``; blank texts stay as they are."""
    return F.when(is_blank(text), text).otherwise(F.concat(text, F.lit("-["), argb, F.lit("]")))


def tag_argb(tagged: Column) -> Column:
    """Colour of the first tag, null without one."""
    return F.nullif(F.regexp_extract(tagged, TAG_FIND, 1), F.lit(""))


def untag(tagged: Column) -> Column:
    """Text without any tag; unchanged when no tag holds a colour."""
    return F.when(tag_argb(tagged).isNotNull(), F.regexp_replace(tagged, TAG_STRIP, "")).otherwise(
        tagged
    )


def cell_role(tagged: Column) -> Column:
    """``timed`` for a coloured text that starts with a digit, ``banner`` for another coloured one."""
    return F.when(
        tag_argb(tagged).isNotNull(),
        F.when(starts_with_digit(tagged), F.lit("timed")).otherwise(F.lit("banner")),
    )

"""Abbreviation and colour of placed items."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.functions.text import Abbreviation, abbreviate, tag

# Fixed value: colour of items that name none.
DEFAULT_COLOR = "Black"


def abbreviate_timed(
    items: DataFrame, abbreviations: Sequence[Abbreviation], text: str = "description"
) -> DataFrame:
    """Abbreviates items with a start time; banners and items without one keep their text."""
    timed = F.coalesce("start_time", F.lit("")) != ""
    return items.withColumn(
        text, F.when(timed, abbreviate(F.col(text), abbreviations)).otherwise(F.col(text))
    )


def color_name(color: Column) -> Column:
    return F.coalesce(F.nullif(color, F.lit("")), F.lit(DEFAULT_COLOR))


def argb_of(color: Column, palette: Mapping[str, str]) -> Column:
    """ARGB of a colour name, null when the palette lacks it. The palette is job
    configuration and becomes a constant map of the plan."""
    known = F.from_json(F.lit(json.dumps(dict(palette))), "map<string,string>")
    return F.try_element_at(known, color_name(color))


def strict_argb(color: Column, palette: Mapping[str, str]) -> Column:
    """`argb_of` that fails the job on a name that the palette lacks."""
    unknown = F.raise_error(F.concat(F.lit("unknown colour "), color_name(color)))
    return F.coalesce(argb_of(color, palette), unknown)


def with_argb(items: DataFrame, palette: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Adds ``argb``. An unknown colour fails the job when ``strict`` and is null otherwise."""
    return items.withColumn("argb", (strict_argb if strict else argb_of)(F.col("color"), palette))


def with_tag(items: DataFrame) -> DataFrame:
    """Adds ``tagged``, the text that carries its colour."""
    return items.withColumn("tagged", tag(F.col("description"), F.col("argb")))
